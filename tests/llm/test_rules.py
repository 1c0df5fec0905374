import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lumbung.llm.rules import STATISTICS, ListBounds, cover, judged, learn_rules, passing


def by_hand(text):
    text = text or ""
    words = text.encode().split()
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    chars = sum(len(w.decode()) for w in words)
    return [len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def check(df):
    for row in df.collect():
        q = row["__quality"]
        assert [q[name] for name in STATISTICS[:5]] == by_hand(row.text), row.text
        failed = q.n_words < 10 or 100 * q.n_repeat_words > 20 * q.n_words
        assert q.base_failed == failed and q.kept == (not failed and q.rule is None)


def test_statistics_and_verdicts(documents, hard_documents, labels):
    rules = learn_rules(documents, labels)
    check(judged(documents, rules))
    check(judged(hard_documents, rules))


def test_learned_list_is_precise_and_is_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = learn_rules(docs, labels)
    assert rules.rules and rules.sql.startswith("CASE WHEN")
    found = judged(docs, rules).join(labels, "doc_id").where("not __quality.base_failed")
    rates = {r.quality: r.k for r in found.groupBy("quality").agg(F.avg(F.col("__quality.kept").cast("int")).alias("k")).collect()}
    assert rates[1] >= 0.98 and rates[0] <= 0.5


def test_cover_finds_a_planted_conjunction():
    rng = np.random.default_rng(5)
    table = {name: rng.random(3000) for name in ("words", "symbols", "upper")}
    bad = (table["symbols"] > 0.7) & (table["upper"] <= 0.4)
    rules = cover(table, bad, ListBounds(precision=0.95))
    fits = np.zeros(3000, bool)
    for rule in rules.rules:
        part = np.ones(3000, bool)
        for condition in rule:
            part &= condition.holds(table)
        fits |= part
    assert (fits & ~bad).sum() <= 0.05 * fits.sum() and (fits & bad).sum() >= 0.9 * bad.sum()


def test_noise_gives_no_rule():
    rng = np.random.default_rng(6)
    table = {"words": rng.random(2000), "upper": rng.random(2000)}
    assert cover(table, rng.random(2000) < 0.3, ListBounds()).rules == ()


def test_defined_cases(hard_documents, no_documents, hard_labels):
    rules = learn_rules(hard_documents, hard_labels.where("quality = 1"))
    assert rules.rules == ()
    kept = passing(hard_documents, rules)
    assert kept.columns == hard_documents.columns
    assert kept.where("text is null or trim(text) = ''").count() == 0
    assert passing(no_documents, learn_rules(no_documents, hard_labels)).collect() == []

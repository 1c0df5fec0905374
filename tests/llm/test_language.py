import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbung.llm import language
from lumbung.llm.labelled import held_out_fold, learning_fold
from lumbung.llm.language import (
    BLOCK,
    TrainingBounds,
    expected_words,
    fit_language_model,
    labelled_sample,
    predict_language,
)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 1, 5])
    scores, move = rng.normal(size=(9, 3)).astype(np.float32), rng.normal(size=(3, 3))
    found = expected_words(scores, counts, move)
    at = 0
    for n, row in zip(counts, found):
        total, weight = np.zeros(3), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            before = -1
            p = 1.0
            for k, state in enumerate(path):
                step = np.exp(move[:, state]).mean() if before < 0 else np.exp(move[before, state])
                p *= step * np.exp(scores[at + k, state])
                before = state
            weight += p
            total += p * np.bincount(path, minlength=3) if n else 0
        assert np.allclose(row, total / weight if n else 0)
        at += n


def test_long_chains_are_whole_across_blocks():
    rng = np.random.default_rng(1)
    counts = np.array([5, 3 * BLOCK + 7, BLOCK, BLOCK + 1])
    scores, move = rng.normal(size=(counts.sum(), 4)).astype(np.float32), rng.normal(size=(4, 4))
    found = expected_words(scores, counts, move)
    at = 0
    for n, row in zip(counts, found):
        a, forward, back = np.exp(move), np.zeros((n, 4)), np.ones((n, 4))
        e = np.exp(scores[at : at + n].astype(float))
        vector = np.full(4, 0.25)
        for k in range(n):
            vector = vector @ a * e[k]
            vector /= vector.sum()
            forward[k] = vector
        for k in range(n - 2, -1, -1):
            back[k] = (back[k + 1] * e[k + 1]) @ a.T
            back[k] /= back[k].sum()
        share = forward * back
        assert np.allclose(row, (share / share.sum(axis=1, keepdims=True)).sum(axis=0))
        at += n


def test_held_out_accuracy_and_switching_texts(spark, documents):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_language_model(given.where(learning_fold("doc_id", 4, 2)))
    found = given.where(held_out_fold("doc_id", 4, 2)).select("lang", predict_language(spark, model).alias("p"))
    right = found.agg(F.avg((F.col("lang") == F.col("p.lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    texts = {r.lang: r.text for r in given.where("length(text) between 1500 and 3000").collect()}
    mixed = [(texts["en"] + " " + texts["de"][:300],), (texts["de"] + " " + texts["en"][:300],)]
    rows = spark.createDataFrame(mixed, "text string").select(predict_language(spark, model).alias("p")).collect()
    assert [r.p.lang_pred for r in rows] == ["en", "de"] and all(0.5 < r.p.score < 0.99 for r in rows)


def test_defined_cases(spark, hard_documents, no_documents):
    model = fit_language_model(hard_documents, TrainingBounds(rounds=3))
    assert model.labels == ["de", "en"]
    rows = hard_documents.withColumn("p", predict_language(spark, model)).collect()
    for row in rows:
        lettered = any(c.isalpha() for c in row.text or "")
        assert (row.p.lang_pred == "und") == (not lettered) and 0 <= row.p.score <= 1
    assert rows[0].score == 1.5  # a column of the same name keeps its values
    assert fit_language_model(no_documents) is None
    lone = hard_documents.select(predict_language(spark, None).alias("p")).select("p.*").distinct().collect()
    assert [tuple(r) for r in lone] == [("und", 0.0)]
    only = fit_language_model(hard_documents.where("lang = 'en'"), TrainingBounds(rounds=2))
    assert only.labels == ["en"]
    assert hard_documents.where("doc_id = 8").select(predict_language(spark, only).alias("p")).first().p.score == 1.0


def test_every_label_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(7)
    names = [f"l{k:02}" for k in range(70)]  # more than TrainingBounds.languages
    words = {name: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(8)] for name in names}
    rows = [(n, " ".join(rng.choice(words[name], 24)), name) for n, name in enumerate(names * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(docs, TrainingBounds(rounds=15))
    assert model.labels == names
    right = docs.select((predict_language(spark, model)["lang_pred"] == F.col("lang")).alias("right")).where("right")
    assert right.count() == len(rows)
    monkeypatch.setattr(language, "MOST_LABELS", 69)
    with pytest.raises(ValueError, match="69 labels"):
        fit_language_model(docs)


def test_no_label_and_no_repeated_row_crowds_out_others(spark):
    hot = "the same text in every row"
    slot = F.pmod(F.xxhash64("id", F.lit(hot)), F.lit(1 << 20))
    hot_id = spark.range(5000).orderBy(slot).first()[0]  # of the earliest rows by hash
    rows = [(hot_id, hot, "en")] * 1000 + [(10_000 + n, f"english text number {n}", "en") for n in range(30)]
    rows += [(20_000 + n, f"deutscher text nummer {n}", "de") for n in range(30)]
    rows += [(30_000 + n, "12 34", "fr") for n in range(50)] + [(30_050, "un seul texte", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    bounds = TrainingBounds(documents=20)
    sample = labelled_sample(docs, bounds)
    assert Counter(label for label, _ in sample) == {"en": 20, "de": 20, "fr": 1}
    assert sum(parts == [hot] for _, parts in sample) <= 1
    assert labelled_sample(docs.repartition(5), bounds) == sample
    many = spark.createDataFrame([(n, f"text {n}", f"l{n % 70}") for n in range(210)], docs.schema)
    few = labelled_sample(many, TrainingBounds(languages=2, documents=3))
    assert len({label for label, _ in few}) == len(few) == 70


FOREIGN = (
    "setiap orang berhak atas semua hak dan kebebasan yang tercantum di dalam pernyataan ini tanpa pengecualian apapun",
    "jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista",
    "każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej deklaracji bez względu na różnice rasy",
    "каждый человек должен обладать всеми правами и всеми свободами провозглашенными настоящей декларацией",
)


def junk(seed, words=40):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(words))


def test_foreign_and_junk_texts_are_unknown_and_switching_ones_known(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_language_model(given.where(learning_fold("doc_id", 4, 2)))
    assert np.isfinite(model.evidence.low)
    found = given.select("text", predict_language(spark, model, known=True).alias("p")).where("p.lang_pred != 'und'")
    assert found.where("not p.known").count() == 0  # learned and held-out documents alike
    texts = {r.lang: r.text for r in given.where("length(text) between 400 and 3000").collect()}
    clean = [f"{texts[a][:200]} {texts[b][:200]} {texts[c][:200]}" for a, b, c in itertools.permutations(texts, 3)]
    clean += [" ".join(w for pair in zip(texts["en"].split(), texts["fr"].split()) for w in pair)]
    clean += [texts["de"][:60], texts["es"][:25]]  # short ones
    clean += [f"{texts['en'][:60]} d79b4bd5ac35c6fd4765f3c195ae8bf92c95a355 06cf6f1ed6e2f11436ae2d0e28ac632b3cf81707"]
    strange = [*FOREIGN, *map(junk, range(4)), FOREIGN[0].upper(), " ".join([FOREIGN[1]] * 300)]
    rows = [(n, text, n < len(clean)) for n, text in enumerate(clean + strange)]
    docs = spark.createDataFrame(rows, "n int, text string, clean boolean")
    wrong = docs.select("n", "text", "clean", predict_language(spark, model, known=True).alias("p")).where("p.known != clean")
    assert wrong.collect() == []


def test_evidence_equals_ratios_by_hand():
    parts = ["abc ab", "ba abc", "é"]
    evidence = language._ratios(parts)
    seen = Counter(b"  " + w.encode() + b" " for p in parts for w in p.split(" "))
    trigrams, contexts, letters = Counter(), Counter(), Counter()
    for word, n in seen.items():
        for k in range(2, len(word)):
            trigrams[word[k - 2 : k + 1]] += n
            contexts[word[k - 2 : k]] += n
            letters[word[k]] += n
    total = sum(letters.values())

    def by_hand(word):
        raw, terms = b"  " + word.encode() + b" ", []
        for k in range(2, len(raw)):
            share = letters[raw[k]] / total
            if trigrams[raw[k - 2 : k + 1]]:
                chance = (trigrams[raw[k - 2 : k + 1]] + 2 * share) / (contexts[raw[k - 2 : k]] + 2)
                terms.append(np.log(chance / share))
            else:
                terms.append(np.log(2 / (2 + contexts[raw[k - 2 : k]])))
        return np.mean(terms)

    words = ["abc", "ab", "zz", "ac", "é", "abc", "xyzabc"]
    found = language.word_evidence(evidence, *language._words_run([" ".join(words)]))
    assert np.allclose(found, [by_hand(w) for w in words])
    assert len(language.word_evidence(evidence, *language._words_run(["12 !"]))) == 0


def test_without_a_level_every_lettered_text_is_known(spark, hard_documents):
    model = fit_language_model(hard_documents.where("doc_id = 9"), TrainingBounds(rounds=2))
    assert model is None or model.evidence.low == -np.inf
    only = spark.createDataFrame([(1, "one lone text", "en")], "doc_id long, text string, lang string")
    model = fit_language_model(only, TrainingBounds(rounds=2))
    assert model.evidence.low == -np.inf
    rows = spark.createDataFrame([("zzqx",), ("12",), (None,), ("",)], "text string")
    assert [r.p.known for r in rows.select(predict_language(spark, model, known=True).alias("p")).collect()] == [True, False, False, False]

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lumbung.llm import labelled, quality_model
from lumbung.llm.labelled import held_out_fold, learning_fold, sampled_labels, sampled_texts
from lumbung.llm.quality_model import EMPTY, FEATURES, FitBounds, fit_quality_model, indicators, quality_score
from lumbung.llm.rules import ListBounds, labelled_statistics


def test_indicators_are_distinct_and_do_not_depend_on_neighbours():
    texts = ["the cat the cat", None, "", "THE CAT!!", " ", "x", "the cat the cat", "é" * 50]
    together = [sorted(x.tolist()) for x in indicators(pa.array(texts))]
    alone = [sorted(next(iter(indicators(pa.array([t], pa.string())))).tolist()) for t in texts]
    assert together == alone and together[0] == together[6]
    assert together[1] == together[2] == together[4] == [EMPTY]
    assert all(len(set(x)) == len(x) and max(x) < FEATURES for x in together)


def test_held_out_ranking(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_quality_model(docs, labels.where(learning_fold("doc_id", 5, 0)))
    found = docs.where(held_out_fold("doc_id", 5, 0)).withColumn("p", quality_score(spark, model)).join(labels, "doc_id")
    rows = found.select("quality", "p").collect()
    good, bad = [r.p for r in rows if r.quality], [r.p for r in rows if not r.quality]
    above = np.mean([g > b for g in good for b in bad])
    assert above >= 0.95
    assert np.mean([(r.p >= 0.3) == bool(r.quality) for r in rows]) >= 0.9


def test_defined_cases(spark, hard_documents, no_documents, hard_labels):
    model = fit_quality_model(hard_documents, hard_labels, FitBounds(per_class=5))
    rows = hard_documents.withColumn("p", quality_score(spark, model)).collect()
    assert all(0 <= r.p <= 1 for r in rows) and len({r.p for r in rows if not (r.text or "").strip()}) == 1
    one = fit_quality_model(hard_documents, hard_labels.where("quality = 1"))
    scored = hard_documents.select(quality_score(spark, one).alias("p"))
    assert scored.agg(F.min("p")).first()[0] > 0.99
    none = fit_quality_model(no_documents, hard_labels)
    assert hard_documents.select(quality_score(spark, none)).distinct().count() == 1
    assert no_documents.select(quality_score(spark, model)).collect() == []


def test_the_sample_is_bounded_and_skips_contradictions(spark, hard_labels):
    assert {r.doc_id for r in sampled_labels(hard_labels, "quality", 1000).collect()} == set(range(20)) - {1} | {900}
    many = spark.range(20_000).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    rows = sampled_labels(many, "quality", 300).collect()
    assert 500 < len(rows) <= 750 and sorted(rows) == sorted(sampled_labels(many.repartition(5), "quality", 300).collect())


def test_no_class_and_no_id_crowds_out_others(spark, monkeypatch):
    rows = [(1, f"one of many texts of an id {n % 900}") for n in range(1000)]  # some are equal
    rows += [(n, f"good text number {n}") for n in range(2, 10)] + [(n, f"bad text number {n}") for n in range(10, 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(n, int(n < 10)) for n in range(1, 16)], "doc_id long, quality int")
    found = sampled_texts(docs, labels, "quality", 12).collect()
    assert Counter(r.label for r in found) == {1: 12, 0: 6}
    assert {r.doc_id for r in found} == set(range(1, 16)) and len({(r.doc_id, r.text) for r in found}) == 18
    assert sorted(found) == sorted(sampled_texts(docs.repartition(5), labels, "quality", 12).collect())
    assert Counter(labelled_statistics(docs, labels, ListBounds(per_class=12))[1].tolist()) == {True: 6, False: 12}
    model = fit_quality_model(docs, labels, FitBounds(per_class=12))
    assert docs.select(quality_score(spark, model)).distinct().count() > 1
    monkeypatch.setattr(labelled, "PENDING", 7)  # tasks drop hashes many times
    assert sorted(found) == sorted(sampled_texts(docs, labels, "quality", 12).collect())
    task = pa.record_batch([pa.array([k % 3 for k in range(60)]), pa.array([k // 2 for k in range(60)])], ["g", "h"])
    (least,) = labelled._least_of_task(iter([task, task]), 4)
    assert Counter(zip(least["g"].to_pylist(), least["h"].to_pylist())) == Counter(
        (g, h) for g in range(3) for h in sorted({k // 2 for k in range(60) if k % 3 == g})[:4]
    )


def test_ratios_are_those_of_whole_texts_and_the_driver_gets_few_columns(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 = 0) AS quality")
    sizes, used = [], []
    collected, descent = quality_model._collected, quality_model._dual_descent

    def watched(sample, most):
        rows = collected(sample, most)
        sizes.append(max(len(row[1]) for row in rows))
        return rows

    def seen(texts, truth, seen, ratios, bounds, random):
        used.append((truth, seen))
        return descent(texts, truth, seen, ratios, bounds, random)

    monkeypatch.setattr(quality_model, "_collected", watched)
    monkeypatch.setattr(quality_model, "_dual_descent", seen)
    whole, few = (fit_quality_model(docs, labels, FitBounds(columns=n, rounds=2)) for n in (1 << 14, 40))
    assert sizes[0] > 40 == sizes[1]
    # by hand: documents with each column in the seen part, smoothed, as shares of their class
    rows = sorted((r.doc_id, r.text, r.quality) for r in docs.join(labels, "doc_id").collect())
    for model, (truth, use) in zip((whole, few), used):
        assert truth.tolist() == [quality for _, _, quality in rows]
        tally = {0: Counter(), 1: Counter()}
        for (_, text, quality), of_part in zip(rows, use):
            if of_part:
                tally[quality].update(next(iter(indicators(pa.array([text])))).tolist())
        total = {k: sum(c.values()) + FEATURES for k, c in tally.items()}
        for column in [*tally[0]][:300] + [*tally[1]][:300] + [EMPTY]:
            want = np.log((tally[1][column] + 1) / total[1] / ((tally[0][column] + 1) / total[0]))
            assert abs(model.ratios[column] - want) < 1e-5


def test_the_descent_ends_at_the_optimum():
    random = np.random.default_rng(3)
    texts = [random.choice(60, random.integers(3, 20), replace=False).astype(np.int32) for _ in range(80)]
    truth = np.array([int(len(set(t.tolist()) & set(range(12))) > 2) for t in texts])
    truth[:6] = 1 - truth[:6]  # not separable
    use, ratios = np.ones(80, bool), random.normal(size=FEATURES)
    use[70:] = False
    bounds = FitBounds(rounds=1500)
    weights, bias, dual = quality_model._dual_descent(texts, truth, use, ratios, bounds, np.random.default_rng(1))
    assert not dual[70:].any()
    sign, loss = np.where(truth == 1, 1, -1), 0.0
    w, b = np.zeros(FEATURES), 0.0
    for k in range(70):
        x = np.zeros(FEATURES)
        x[texts[k]] = ratios[texts[k]] / np.linalg.norm(ratios[texts[k]])
        cost = 70 / (2 * (truth[:70] == truth[k]).sum())
        assert -1e-12 <= dual[k] <= cost + 1e-12
        loss += cost * max(0.0, 1 - sign[k] * (weights @ x + bias))
        w, b = w + dual[k] * sign[k] * x, b + dual[k] * sign[k]
    assert np.allclose(w, weights) and np.isclose(b, bias)  # the weights are those of the dual variables
    half = (weights @ weights + bias * bias) / 2
    assert 0 <= (half + loss) - (dual.sum() - half) < 1e-3 * (half + loss)  # no gap: nothing is better

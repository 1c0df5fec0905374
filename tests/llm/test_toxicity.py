import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from lumbung.llm.labelled import held_out_fold, learning_fold
from lumbung.llm.toxicity import (
    LEVEL,
    STRIDE,
    WINDOW,
    Distances,
    ToxicityBounds,
    fit_to_sample,
    fit_toxicity_model,
    plain_bytes,
    score_texts,
    toxic_sequences,
    toxicity_score,
    train_dictionaries,
    windows_of,
)


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return fit_toxicity_model(docs, labels.where(learning_fold("doc_id", 4, 2)))


def brute_windows(text):
    out, at = [text[:WINDOW]], STRIDE
    while at - STRIDE + WINDOW < len(text):
        out.append(text[at : at + WINDOW])
        at += STRIDE
    return out


def brute_score(model, text):
    """One window after the other, through zstandard's plain interface."""
    def length(content, window):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        pack = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        return len(pack.compress(window))

    d = [length(model.ordinary, w) - length(model.toxic, w) for w in brute_windows(plain_bytes(text))]
    low, high = (sum(max(0, x - limit) for x in d) for limit in (model.low, model.high))
    n = len(d)
    x = np.array([max(d), sum(d) / n, low / n, high / n, np.log(1 + low), np.log(1 + n)])
    z = ((x - model.centre) / model.scale) @ model.weights[:-1] + model.weights[-1]
    return 1 / (1 + np.exp(-z))


def test_windows_cover_every_byte_of_each_text_and_no_other():
    sizes = np.array([2, 63, 64, 65, 104, 105, 1000, 2])
    segments, owner = windows_of(sizes)
    begins = np.cumsum(sizes) - sizes
    for k, (size, begin) in enumerate(zip(sizes.tolist(), begins.tolist())):
        mine = segments[owner == k].astype(int)
        covered = {b for a, n in mine.tolist() for b in range(a, a + n)}
        assert covered == set(range(begin, begin + size))
        text = bytes(k for k in range(size % 256)) * (size // max(1, size % 256) + 1)
        assert [n for _, n in mine.tolist()] == [len(w) for w in brute_windows(text[:size])]


def test_scores_equal_those_of_single_windows(learned, documents):
    texts = [r.text for r in documents.orderBy("doc_id").limit(12).collect()]
    texts += [None, "", "You IDIOT", "x" * 65, "é " * 500, "worthless  \n pathetic\tscum " * 40]
    distances = Distances(learned.ordinary, learned.toxic)
    got = score_texts(learned, distances, pa.array(texts))
    assert np.allclose(got, [brute_score(learned, t) for t in texts], atol=1e-12)
    alone = [score_texts(learned, distances, pa.array([t], pa.string()))[0] for t in texts]
    assert np.array_equal(got, alone)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit_toxicity_model(docs, labels.where(learning_fold("doc_id", 4, 2)))
    found = docs.where(held_out_fold("doc_id", 4, 2)).withColumn("p", toxicity_score(spark, model))
    rows = found.join(labels, "doc_id").select("toxic", "p").collect()
    bad, good = [r.p for r in rows if r.toxic], [r.p for r in rows if not r.toxic]
    assert len(bad) > 100 and np.mean([b > g for b in bad for g in good]) >= 0.92
    assert np.mean([b >= 0.3 for b in bad]) >= 0.7 and np.mean([g >= 0.3 for g in good]) <= 0.04


def test_a_toxic_passage_in_a_long_clean_text_is_found(learned, documents):
    clean = " ".join(r.text for r in documents.where("lang = 'en'").orderBy("doc_id").limit(8).collect())
    insult = " you worthless pathetic idiot, stupid disgusting scum and moron, loser, clown, trash "
    distances = Distances(learned.ordinary, learned.toxic)
    middle = len(clean) // 2
    one, two = score_texts(learned, distances, pa.array([clean, clean[:middle] + insult * 3 + clean[middle:]]))
    assert two > one


def test_toxic_sequences_are_those_of_more_documents():
    ordinary = [plain_bytes(f"a plain text number {n} about weather") for n in range(40)]
    toxic = [plain_bytes(f"a plain text number {n} you grumblefish") for n in range(20)]
    marks = set(toxic_sequences(ordinary, toxic, ToxicityBounds()).tolist())

    def number(text):
        return int.from_bytes(text, "big")

    whole = b" you grumblefish "
    assert {number(whole[k : k + 6]) for k in range(len(whole) - 5)} <= marks
    assert number(b" plain") not in marks and number(b"weathe") not in marks
    common, own = train_dictionaries(ordinary, toxic, ToxicityBounds())
    assert len(common) == len(own) and b"umblefis" in own and b"umblefis" not in common
    window = plain_bytes("some new grumblefish here, it is a plain text about weather")
    distances = Distances(common, own)
    assert distances.of(window, windows_of(np.array([len(window)]))[0]).max() > 0


def test_defined_cases(spark, learned, hard_documents, no_documents, hard_labels):
    rows = hard_documents.withColumn("p", toxicity_score(spark, learned)).collect()
    assert all(0 <= r.p <= 1 for r in rows) and len({r.p for r in rows if not (r.text or "").strip()}) == 1
    assert no_documents.select(toxicity_score(spark, learned)).collect() == []
    fitted = fit_toxicity_model(hard_documents, hard_labels.withColumn("toxic", F.col("quality")), ToxicityBounds(5))
    assert all(0 <= r[0] <= 1 for r in hard_documents.select(toxicity_score(spark, fitted)).collect())
    one = fit_toxicity_model(hard_documents, hard_labels)  # class 0 alone is found among the documents
    assert all(r[0] < 0.5 for r in hard_documents.select(toxicity_score(spark, one)).collect())
    none = fit_toxicity_model(no_documents, hard_labels)
    assert {r[0] for r in hard_documents.select(toxicity_score(spark, none)).collect()} == {0.5}


def test_the_fit_does_not_depend_on_the_order_of_rows(spark, documents, labels):
    bounds = ToxicityBounds(per_class=60, windows=2000)
    one = fit_toxicity_model(documents, labels, bounds)
    two = fit_toxicity_model(documents.repartition(5), labels.repartition(3), bounds)
    assert one.ordinary == two.ordinary and one.toxic == two.toxic and np.allclose(one.weights, two.weights)
    assert zlib.crc32(one.toxic) == zlib.crc32(two.toxic)


def test_a_sample_without_toxic_sequences_gives_the_share_of_the_class():
    texts = [plain_bytes(f"text {n}") for n in range(40)]
    model = fit_to_sample(texts, np.array([n % 2 for n in range(40)]), 0.1, ToxicityBounds())
    scores = score_texts(model, Distances(model.ordinary, model.toxic), pa.array(["text 3", "other", None]))
    assert np.allclose(scores, 0.1, atol=0.05)

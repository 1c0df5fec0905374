import glob
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumbung.llm.shards import (
    END_TOKEN,
    VOCABULARY,
    Layout,
    Tokenizer,
    _streams,
    _token_counts,
    materialise,
    permuted,
    read_from,
    run_of_shards,
    writing_tasks,
)

LAYOUT = Layout(length=16, per_shard=10)


@pytest.fixture(scope="module")
def tokenizer():
    with open(VOCABULARY, "rb") as file:
        return Tokenizer(file.read())


def tokens_of(tokenizer, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "t"])
    out = []
    for _, begins, sizes, counts in _streams(iter([batch]), tokenizer):
        ends = np.cumsum(_token_counts(sizes, counts))
        out += [part.tolist() for part in np.split(tokenizer.tokens(begins, sizes), ends)[:-1]]
    return out


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 4, 5, 17, 255, 256, 257, 5000):
        slots = permuted(np.arange(n), n, key=9)
        assert sorted(slots.tolist()) == list(range(n))
        assert permuted(slots, n, key=9, inverse=True).tolist() == list(range(n))
    assert (permuted(np.arange(5000), 5000, key=1) != permuted(np.arange(5000), 5000, key=2)).mean() > 0.99


def test_tokens_are_those_of_the_whole_text(tokenizer, hard_documents, documents):
    texts = [r.text for df in (hard_documents, documents) for r in df.select("text").collect()]
    rng = np.random.default_rng(3)
    signs = [" ", "a", "é", "\n", ".", " ", " ", "’", "7", "\x1c", "\x85", "字"]
    texts += ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(400)]
    for text, tokens in zip(texts, tokens_of(tokenizer, texts)):
        assert tokens == tokenizer.encoding.encode_ordinary(text or "")


def test_round_trip_in_training_order(spark, tokenizer, hard_documents, folder):
    docs_path = f"{folder}/docs"
    hard_documents.repartition(5).write.parquet(docs_path)
    docs = spark.read.parquet(docs_path)
    index = materialise(docs, f"{folder}/out", key=77, layout=LAYOUT).collect()
    total = len(index)
    assert sorted(r.slot for r in index) == list(range(total))
    assert all(r.shard == r.slot // 10 and r.offset == r.slot % 10 * LAYOUT.stride for r in index)
    stored = {r.slot: r.tokens for r in read_from(spark, f"{folder}/out", 0, LAYOUT).collect()}
    assert sorted(stored) == list(range(total)) and all(len(t) == 16 for t in stored.values())
    # the streams of the tasks, in the order of their sequences
    order = permuted(np.arange(total), total, 77).tolist()
    by_slot = {r.slot: r for r in index}
    stream, ends = [], 0
    for slot in order:
        stream += list(stored[slot])[: by_slot[slot].tokens]
        padding = list(stored[slot])[by_slot[slot].tokens :]
        assert all(t == END_TOKEN for t in padding)
    for token in stream:
        ends += token == END_TOKEN
    texts = [r.text for r in hard_documents.collect()]
    assert ends == len(texts)
    pieces, part = [], []
    for token in stream:
        if token == END_TOKEN:
            pieces.append(tuple(part))
            part = []
        else:
            part.append(token)
    assert sorted(pieces) == sorted(tuple(t) for t in tokens_of(tokenizer, texts))


def test_resumed_reads(spark, hard_documents, folder):
    hard_documents.write.parquet(f"{folder}/docs")
    materialise(spark.read.parquet(f"{folder}/docs"), f"{folder}/out", key=1, layout=LAYOUT).count()
    whole = [tuple(r) for r in read_from(spark, f"{folder}/out", 0, LAYOUT).collect()]
    for slot in (0, 9, 10, 23, len(whole) - 1):
        assert [tuple(r) for r in read_from(spark, f"{folder}/out", slot, LAYOUT).collect()] == whole[slot:]


def test_ids_of_a_sequence_are_its_documents(spark, folder):
    rows = [(n, "w" * n) for n in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    index = materialise(docs, f"{folder}/out", key=5, layout=LAYOUT).collect()
    order = permuted(np.arange(len(index)), len(index), 5).tolist()
    by_slot = {r.slot: r.doc_ids for r in index}
    ids = [by_slot[slot] for slot in order]
    assert sorted({i for part in ids for i in part}) == list(range(40))
    assert all(part == sorted(part) for part in ids)
    assert all(a[-1] <= b[0] for a, b in zip(ids, ids[1:]))


def test_no_documents(spark, no_documents, folder):
    no_documents.write.parquet(f"{folder}/docs")
    assert materialise(spark.read.parquet(f"{folder}/docs"), f"{folder}/out", key=1, layout=LAYOUT).collect() == []


def test_tasks_follow_the_bytes_and_not_the_shards(spark):
    layout = Layout()
    assert writing_tasks(3_000_000, layout, 8) == -(-3_000_000 // (layout.task_bytes // (4096 * layout.stride)))
    small = Layout(length=16, per_shard=10)  # as many shards of 330 bytes are 1 GB
    assert writing_tasks(3_000_000, small, 1) == 2 and writing_tasks(3_000_000, small, 8) == 8
    assert [writing_tasks(n, layout, 8) for n in (1, 5, 8, 100)] == [1, 5, 8, 8]
    assert writing_tasks(7, Layout(task_bytes=1), 2) == 7  # a shard is never cut
    for shards, tasks in ((1, 1), (7, 3), (100, 8), (64, 64), (3_000_001, 97)):
        rows = spark.range(shards).select(F.col("id").alias("shard")).select("shard", run_of_shards(shards, tasks).alias("t"))
        runs = rows.groupBy("t").agg(F.min("shard").alias("a"), F.max("shard").alias("b"), F.count("*").alias("n"))
        runs = sorted(map(tuple, runs.collect()))
        assert [t for t, *_ in runs] == list(range(tasks))
        assert all(b - a + 1 == n for _, a, b, n in runs) and runs[0][1] == 0
        assert max(n for *_, n in runs) - min(n for *_, n in runs) <= 1


def test_shards_of_a_run_are_whole_files(spark, hard_documents, folder):
    hard_documents.write.parquet(f"{folder}/docs")
    layout = Layout(length=16, per_shard=3, task_bytes=1 << 20)
    index = materialise(spark.read.parquet(f"{folder}/docs"), f"{folder}/out", key=3, layout=layout)
    shards = index.agg(F.max("shard")).first()[0] + 1
    assert shards > 8 * spark.sparkContext.defaultParallelism
    files = glob.glob(f"{folder}/out/shards/shard=*/part-*")
    sizes = {int(f.split("shard=")[1].split("/")[0]): os.path.getsize(f) for f in files}
    assert len(files) == len(sizes) == shards
    assert all(size == 3 * layout.stride for shard, size in sizes.items() if shard < shards - 1)
    stored = read_from(spark, f"{folder}/out", 0, layout).collect()
    assert [r.slot for r in stored] == list(range(index.count()))


def test_a_write_leaves_the_session_as_it_was(spark, hard_documents, folder):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    hard_documents.write.parquet(f"{folder}/docs")
    docs, before = spark.read.parquet(f"{folder}/docs"), spark.conf.get(name)
    rows = [
        [tuple(r) for r in read_from(spark, f"{folder}/{size}", 0, layout).collect()]
        for size in (1, 1 << 20)
        if materialise(docs, f"{folder}/{size}", key=3, layout=(layout := Layout(16, 10, batch_bytes=size))).count()
    ]
    assert rows[0] == rows[1] and rows[0] and spark.conf.get(name) == before

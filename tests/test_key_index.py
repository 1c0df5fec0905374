import os
import random

import pytest
from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F

from lumbung.operators import new_rows
from lumbung.operators.key_index import MOST_ZONES, key_bloom, key_zones, word_count
from lumbung.sources.stores import ParquetStore

SCHEMA = "id string, t string"


def events(spark, prefix, numbers, text="x"):
    return frame(spark, SCHEMA, *[(f"{prefix}-{n:06d}", text) for n in numbers])


def files(folder):
    return {f for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_same_rows_as_without_an_index(spark, tmp_path, seed):
    rng = random.Random(seed)
    schema = "a string, b int, t string"
    plain, indexed = ParquetStore(spark, str(tmp_path / "p")), ParquetStore(spark, str(tmp_path / "i"))
    for batch in range(5):
        rows = [
            (rng.choice([None, "K", f"{rng.choice('KLM')}{rng.randrange(60)}"]), rng.choice([None, *range(4)]), str(n))
            for n in range(rng.choice([0, 3, 40]))
        ]
        name = f"B{rng.randrange(4)}"  # some batches are loaded again
        for store, key_index in ((plain, False), (indexed, batch != 2)):  # one has no summary
            store.append_new("t", frame(spark, schema, *rows), ["a", "b"], name, schema, null_safe=True, key_index=key_index)
    got, want = (s.read("t").select("a", "b", "t", "etl_batch_id") for s in (indexed, plain))
    assert rows_of(got) == rows_of(want)


def test_only_batches_that_may_hold_a_key_are_read(spark, folder):
    store = ParquetStore(spark, folder)
    for batch in range(6):
        low = 1000 * batch
        rows = events(spark, "ZB", range(low, low + 300)).union(events(spark, "KJ", range(low, low + 300)))
        assert store.append_new("t", rows, ["id"], f"B{batch}", SCHEMA, key_index=True).n_new == 600
    history = {f"B{n}" for n in range(6)}
    choose = store.key_summaries("t").candidates
    assert choose(events(spark, "ZB", range(6000, 6300)), ["id"], history) == set()
    assert choose(events(spark, "KJ", [2150, 2151, 9000]), ["id"], history) == {"B2"}
    assert choose(events(spark, "RC", [2150]), ["id"], history) == set()  # another zone
    between = choose(events(spark, "ZB", range(400, 900)), ["id"], history)
    assert between == set()
    store.key_summaries("t").forget("B4")
    assert choose(events(spark, "KJ", [2150]), ["id"], history) == {"B2", "B4"}
    existing = store.read_existing("t", SCHEMA).where(F.col("etl_batch_id").isin("B2"))
    assert all("etl_batch_id=B2" in f for f in existing.inputFiles()) or "PartitionFilters" in plan_of(existing)
    late = events(spark, "KJ", [2150, 2999])
    assert store.append_new("t", late, ["id"], "B6", SCHEMA, key_index=True).n_new == 1


def test_a_filter_misses_no_key_and_admits_few_others(spark, folder):
    store, rng = ParquetStore(spark, folder), random.Random(5)
    numbers = rng.sample(range(200_000), 4000)
    store.append_new("t", events(spark, "A", numbers[:2000]), ["id"], "B1", SCHEMA, key_index=True)
    choose = store.key_summaries("t").candidates
    assert all(choose(events(spark, "A", [n]), ["id"], {"B1"}) == {"B1"} for n in numbers[:3])
    wrong = sum(bool(choose(events(spark, "A", numbers[k : k + 100]), ["id"], {"B1"})) for k in range(2000, 2600, 100))
    assert wrong <= 2  # 600 keys of no batch; the filter lets some 1 of 20,000 through
    bloom = key_bloom(events(spark, "A", numbers[:2000]), ["id"], 2000)
    assert bloom.count() <= word_count(2000) == 1024


def test_many_zones_become_one(spark):
    rows = frame(spark, SCHEMA, *[(f"{chr(65 + n % 26)}{chr(65 + n // 26)}-{n}", "x") for n in range(300)])
    assert [r.zone for r in key_zones(rows, ["id"]).collect()] == [None]
    few = key_zones(rows.limit(20), ["id"])
    assert few.count() == 20 <= MOST_ZONES and rows_of(key_zones(rows.where("false"), ["id"])) == []
    numbers = key_zones(frame(spark, "id int", (5,), (None,), (9,)), ["id"]).first()
    assert (numbers.zone, numbers.low, numbers.high, numbers.nulls, numbers.n) == ("", 5, 9, 1, 3)


def test_latest_row_of_each_key_and_untouched_files(spark, folder):
    store = ParquetStore(spark, folder)
    parts = [events(spark, "E", range(1000 * b, 1000 * b + 50), "pending") for b in range(3)]
    for b, rows in enumerate(parts):
        assert store.load_latest("t", rows, ["id"], f"B{b}", SCHEMA).n_new == 50
    log = store.versions("t")
    before = dict(log.current().parts)
    held = {b: files(log.folder(f)) for b, f in before.items()}
    changed = frame(spark, SCHEMA, ("E-001003", "paid"), ("E-001004", "pending"), ("E-009000", "pending"))
    result = store.load_latest("t", changed, ["id"], "B3", SCHEMA)
    assert (result.n_in, result.n_new) == (3, 2)  # one is there as it is
    after = log.current().parts
    assert {b for b in before if after[b] != before[b]} == {"B1"}
    assert {b: files(log.folder(after[b])) for b in ("B0", "B2")} == {b: held[b] for b in ("B0", "B2")}
    rows = {r.id: (r.t, r.etl_batch_id) for r in store.read_parts("t").collect()}
    assert len(rows) == 151 == store.read_parts("t").count()
    assert rows["E-001003"] == ("paid", "B3") and rows["E-001004"] == ("pending", "B1")
    again = store.load_latest("t", changed, ["id"], "B3", SCHEMA)
    assert again.n_new == 0 and log.current().parts == after
    more = frame(spark, SCHEMA, ("E-001003", "failed"), ("E-009001", "x"), ("E-009001", "y"))
    assert store.load_latest("t", more, ["id"], "B3", SCHEMA).n_new == 2
    rows = {r.id: r.t for r in store.read_parts("t").collect()}
    assert len(rows) == 152 == store.read_parts("t").count() and rows["E-001003"] == "failed" and rows["E-009001"] == "x"


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_equals_a_dictionary(spark, folder, seed):
    rng, store, want = random.Random(seed), ParquetStore(spark, folder), {}
    for batch in range(5):
        rows = {f"K-{rng.randrange(40)}": rng.choice(["a", "b", None]) for _ in range(rng.choice([0, 5, 25]))}
        store.load_latest("t", frame(spark, SCHEMA, *rows.items()), ["id"], f"B{batch}", SCHEMA, count_input=False)
        want |= rows
        assert rows_of(store.read_parts("t").select("id", "t")) == sorted(want.items(), key=lambda x: [(y is not None, str(y)) for y in x])


def test_a_failed_load_of_the_latest_rows_changes_nothing(spark, folder, monkeypatch):
    store = ParquetStore(spark, folder)
    store.load_latest("t", events(spark, "E", range(30), "old"), ["id"], "B0", SCHEMA)
    monkeypatch.setattr(ParquetStore, "_write_part", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.load_latest("t", events(spark, "E", range(5), "new"), ["id"], "B1", SCHEMA)
    assert {r.t for r in store.read_parts("t").collect()} == {"old"} and store.read_parts("t").count() == 30
    monkeypatch.undo()
    assert store.load_latest("t", events(spark, "E", range(5), "new"), ["id"], "B1", SCHEMA).n_new == 5
    assert store.read_parts("t").count() == 30


def test_repeated_keys_of_a_batch(spark, folder):
    store = ParquetStore(spark, folder)
    store.append_new("t", events(spark, "E", range(100)), ["id"], "B0", SCHEMA, key_index=True)
    late = events(spark, "E", [200, 201, 201])
    store.append_new("t", late, ["id"], "B1", SCHEMA, key_index=True)
    assert rows_of(store.repeated_keys("t", ["id"], "B1", SCHEMA)) == [("E-000201", 2)]
    assert store.repeated_keys("t", ["id"], "B0", SCHEMA).count() == 0
    # a row that came past the load policy
    events(spark, "E", [7]).withColumn("etl_loaded_at", F.current_timestamp()).write.mode("append").parquet(
        f"{folder}/t/etl_batch_id=B2"
    )
    assert rows_of(store.repeated_keys("t", ["id"], "B2", SCHEMA)) == [("E-000007", 2)]


def test_new_rows_are_still_exact(spark):
    assert new_rows(events(spark, "E", [1, 2]), events(spark, "E", [1]), ["id"]).count() == 1

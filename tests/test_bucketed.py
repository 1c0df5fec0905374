import random

import pytest
from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F

from lumbung.operators import lookup
from lumbung.sources.bucketed import BucketedTables, colocated_lookup
from lumbung.sources.stores import ParquetStore

LEFT, RIGHT = "platform string, id string, n int", "p string, i string, gid string"
KEYS, OTHER = ["platform", "id"], ["p", "i"]


def tables_of(spark, seed, n=400, hot=0):
    rng = random.Random(seed)
    left = [(rng.choice(["ZB", "KJ", None]), rng.choice([None, *map(str, range(30))]), k) for k in range(n)]
    left += [("ZB", "7", n + k) for k in range(hot)]
    right = [(p, str(k), f"{p}{k}") for p in ("ZB", "KJ") for k in range(25)] + [(None, "1", "x"), ("ZB", None, "y")]
    return frame(spark, LEFT, *left), frame(spark, RIGHT, *right)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [0, 300])
def test_the_same_rows_as_a_lookup_and_no_shuffle(spark, folder, no_broadcast, how, hot):
    left, right = tables_of(spark, 1, hot=hot)
    tables = BucketedTables(spark, folder, buckets=4)
    a, b = tables.write("events", left, KEYS), tables.write("bridge", right, OTHER, unique=True)
    assert rows_of(a.hot_keys) == ([("ZB", "7")] if hot else [])
    assert rows_of(a.rows()) == rows_of(left)
    found = colocated_lookup(a, b, {"gid": "global_id"}, how)
    plan = plan_of(found)
    assert "hashpartitioning" not in plan and "Exchange SinglePartition" not in plan and "SortMergeJoin" in plan
    assert rows_of(found) == rows_of(lookup(left, right, dict(zip(KEYS, OTHER)), {"gid": "global_id"}, how))


def test_read_in_a_session_that_did_not_write(spark, folder, no_broadcast):
    left, right = tables_of(spark, 2, hot=300)
    tables = BucketedTables(spark, folder, buckets=4)
    for name, rows, keys, unique in (("events", left, KEYS, False), ("bridge", right, OTHER, True)):
        tables.write(name, rows, keys, unique=unique)
    for table in spark.catalog.listTables():
        if table.name.startswith("lumbung_"):
            spark.sql(f"DROP TABLE {table.name}")  # external: the files stay
    found = colocated_lookup(tables.read("events"), tables.read("bridge"), ["gid"])
    assert "hashpartitioning" not in plan_of(found)
    assert rows_of(found) == rows_of(lookup(left, right, dict(zip(KEYS, OTHER)), ["gid"]))


def test_a_bridge_with_a_repeated_key_is_an_error_and_leaves_the_table(spark, folder):
    _, right = tables_of(spark, 3)
    tables = BucketedTables(spark, folder, buckets=4)
    tables.write("bridge", right, OTHER, unique=True)
    with pytest.raises(ValueError, match="rows of one key"):
        tables.write("bridge", right.union(right), OTHER, unique=True)
    assert rows_of(tables.read("bridge").rows()) == rows_of(right)


def test_what_cannot_be_located_together(spark, folder):
    left, right = tables_of(spark, 4)
    tables = BucketedTables(spark, folder, buckets=4)
    a, b = tables.write("events", left, KEYS), tables.write("bridge", right, OTHER, unique=True)
    with pytest.raises(ValueError, match="unique"):
        colocated_lookup(b, a, ["n"])
    numbers = tables.write("numbers", right.select("p", F.expr("try_cast(i AS int)").alias("i"), "gid"), OTHER, unique=True)
    with pytest.raises(ValueError, match="types"):
        colocated_lookup(a, numbers, ["gid"])
    with pytest.raises(ValueError, match="buckets"):
        BucketedTables(spark, folder, buckets=8).read("events")


def test_empty_tables(spark, folder):
    left, right = tables_of(spark, 5)
    tables = BucketedTables(spark, folder, buckets=4)
    none, some = tables.write("none", right.limit(0), OTHER, unique=True), tables.write("events", left, KEYS)
    assert colocated_lookup(some, none, ["gid"]).where("gid IS NULL").count() == left.count()
    empty = tables.write("empty", left.limit(0), KEYS)
    assert colocated_lookup(empty, tables.write("b", right, OTHER, unique=True), ["gid"]).count() == 0


def test_orphans_of_a_batch(spark, folder):
    store, parent, child = ParquetStore(spark, folder), "id bigint, t string", "fk int, k int"
    for batch, numbers in (("P1", range(0, 50)), ("P2", range(100, 150)), ("P3", range(200, 250))):
        store.append_new("parent", frame(spark, parent, *[(n, "x") for n in numbers]), ["id"], batch, parent, key_index=True)
    rows = [(n, k) for k, n in enumerate([120, 120, 130, 160, 160, None])]
    store.append_new("child", frame(spark, child, *rows), ["k"], "B1", child)
    store.append_new("child", frame(spark, child, (7, 100), (99, 101)), ["k"], "B2", child)

    def orphans(batch):
        return store.orphan_keys("child", "fk", batch, child, "parent", "id", parent)

    assert rows_of(orphans("B1")) == [(160, 2)]
    assert rows_of(orphans("B2")) == [(99, 1)]
    assert "P1" not in plan_of(orphans("B1")).split("PartitionFilters")[-1].split("]")[0]

import os

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumbung.sources import versions
from lumbung.sources.stores import ParquetStore
from lumbung.sources.versions import CommitConflict, VersionLog

SCHEMA = "k int, t string"


def failing(df):
    """Some tasks write their files, one fails."""
    bad = F.when(F.col("k") == 7, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("t"))
    return df.repartition(4, "k").withColumn("t", bad)


def test_a_load_that_fails_leaves_the_rows_before_it(spark, folder):
    store = ParquetStore(spark, folder)
    rows = frame(spark, SCHEMA, *[(n, "old") for n in range(10)])
    new = frame(spark, SCHEMA, *[(n, "new") for n in range(10)])
    with pytest.raises(Exception, match="lost"):
        store.snapshot("d", failing(rows), "B0", SCHEMA)
    assert not store.exists("d") and store.version("d") == ""
    store.snapshot("d", rows, "B1", SCHEMA)
    before = store.version("d")
    with pytest.raises(Exception, match="lost"):
        store.snapshot("d", failing(new), "B2", SCHEMA)
    assert store.version("d") == before
    assert rows_of(store.read("d").select("k", "t")) == rows_of(rows)
    assert store.snapshot("d", new, "B2", SCHEMA).n_new == 10
    assert {r.t for r in store.read("d").collect()} == {"new"}


def test_a_reader_ends_on_the_version_it_began_with(spark, folder):
    store = ParquetStore(spark, folder)
    store.write("d", frame(spark, SCHEMA, (1, "one")))
    reader = store.read("d")
    store.write("d", frame(spark, SCHEMA, (2, "two")))
    assert rows_of(reader) == [(1, "one")]
    assert rows_of(store.read("d")) == [(2, "two")]
    store.write("d", frame(spark, SCHEMA, (3, "three")))
    folders = os.listdir(f"{folder}/d/_versions")
    assert len(folders) == 2 and len([n for n in os.listdir(f"{folder}/d/_commits") if n.isdigit()]) == 2
    assert rows_of(spark.read.parquet(store.path("d"))) == [(3, "three")]


def test_a_table_can_be_made_from_the_version_it_replaces(spark, folder):
    store = ParquetStore(spark, folder)
    store.write("d", frame(spark, SCHEMA, (1, "a")))
    for n in range(3):
        store.write("d", store.read("d").union(frame(spark, SCHEMA, (n + 2, "b"))))
    assert rows_of(store.read("d").select("k")) == [(1,), (2,), (3,), (4,)]


def test_two_writers_at_once_do_not_mix(spark, folder):
    log = VersionLog(spark, f"{folder}/d")
    one, two = log.current(), log.current()
    log.commit({"": "a"}, one)
    with pytest.raises(CommitConflict):
        log.commit({"": "b"}, two)
    assert log.current().parts == {"": "a"}


def test_folders_of_failed_loads_go_when_they_are_old(spark, folder, monkeypatch):
    store = ParquetStore(spark, folder)
    store.write("d", frame(spark, SCHEMA, (1, "a")))
    with pytest.raises(Exception, match="lost"):
        store.write("d", failing(frame(spark, SCHEMA, *[(n, "x") for n in range(10)])))
    store.write("d", frame(spark, SCHEMA, (2, "a")))
    assert len(os.listdir(f"{folder}/d/_versions")) == 3
    monkeypatch.setattr(versions, "ORPHAN_HOURS", 0.0)
    store.write("d", frame(spark, SCHEMA, (3, "a")))
    assert len(os.listdir(f"{folder}/d/_versions")) == 2 and rows_of(store.read("d").select("k")) == [(3,)]


def test_rows_are_counted_on_their_way_to_the_files(spark, folder):
    store, scans = ParquetStore(spark, folder), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    rows = frame(spark, SCHEMA, *[(n, "x") for n in range(50)]).mapInArrow(seen, SCHEMA)
    assert store.snapshot("d", rows, "B1", SCHEMA).n_new == 50
    assert scans.value == 50
    assert store.snapshot("d", rows.where("false"), "B2", SCHEMA).n_new == 0


def test_a_table_of_plain_files_is_read_and_replaced(spark, folder):
    frame(spark, SCHEMA, (1, "plain")).write.parquet(f"{folder}/d")
    store = ParquetStore(spark, folder)
    assert store.exists("d") and rows_of(store.read("d")) == [(1, "plain")]
    store.write("d", frame(spark, SCHEMA, (2, "versioned")))
    assert rows_of(store.read("d")) == [(2, "versioned")]

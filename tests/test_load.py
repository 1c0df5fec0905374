import random

import pytest
from helpers import frame, plan_of, rows_of

from lumbung.operators import audit_columns, new_batch_id, new_rows
from lumbung.sources.stores import JdbcStore, ParquetStore, jdbc_column_types, shared_folder
from lumbung.streaming import append_file_drops

FACT = "day bigint, device bigint, event string"


def test_batch_id():
    import datetime as dt

    assert new_batch_id(dt.datetime(2024, 1, 2, 3, 4, 5)) == "BATCH-20240102-030405"


def test_audit_columns(spark):
    row = audit_columns(frame(spark, "x int", (1,)), "B1").first()
    assert row.etl_batch_id == "B1" and row.etl_loaded_at is not None


def test_no_history_means_all_rows_are_new(spark):
    incoming = frame(spark, "id int", (1,), (1,), (None,))
    assert new_rows(incoming, None, ["id"]).count() == 3
    assert new_rows(incoming, incoming.limit(0), ["id"]).count() == 3


def test_single_key_is_insert_only(spark):
    existing = frame(spark, "id int, state string", (1, "old"), (2, "old"))
    incoming = frame(spark, "id int, state string", (1, "new"), (3, "new"), (3, "again"))
    assert rows_of(new_rows(incoming, existing, ["id"])) == [(3, "again"), (3, "new")]
    once = new_rows(incoming, existing, ["id"], once_per_batch=True)
    assert rows_of(once) == [(3, "again")]


def test_null_key_parts_are_equal_only_when_asked(spark):
    existing = frame(spark, FACT, (1, None, "a"), (2, 5, "b"))
    incoming = frame(spark, FACT, (1, None, "c"), (2, 5, "d"), (2, None, "e"), (None, None, "f"))
    keys = ["day", "device"]
    safe = new_rows(incoming, existing, keys, null_safe=True)
    assert {r.event for r in safe.collect()} == {"e", "f"}
    plain = new_rows(incoming, existing, keys)
    assert {r.event for r in plain.collect()} == {"c", "e", "f"}


def test_only_the_keys_of_the_history_are_read(spark, folder):
    frame(spark, FACT, (1, 2, "a")).write.parquet(f"{folder}/old")
    frame(spark, FACT, (1, 2, "a"), (1, 3, "b")).write.parquet(f"{folder}/new")
    old, new = spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new")
    plan = plan_of(new_rows(new, old, ["day", "device"], null_safe=True))
    assert "ReadSchema: struct<day:bigint,device:bigint>\n" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "LeftAnti" in plan


def test_store_loads(spark, folder):
    store = ParquetStore(spark, folder)
    schema = "id int, state string"
    rows = frame(spark, schema, (1, "a"), (2, "b"), (2, "c"))
    first = store.append_new("t", rows, ["id"], "B1", schema)
    assert (first.n_in, first.n_new, first.n_skipped) == (3, 3, 0)
    more = rows.union(frame(spark, schema, (3, "d")))
    second = store.append_new("t", more, ["id"], "B2", schema)
    assert (second.n_in, second.n_new, second.n_skipped) == (4, 1, 3)
    again = store.append_new("t", more, ["id"], "B2", schema)
    assert again.n_new == 1 and store.read("t").count() == 4
    third = store.append_new("t", more, ["id"], "B3", schema)
    assert third.n_new == 0 and store.read("t").count() == 4
    assert store.append_new("t", more, ["id"], "B4", schema, count_input=False).n_skipped is None


def test_an_empty_repeat_empties_its_batch(spark, folder):
    store, schema = ParquetStore(spark, folder), "id int, state string"
    rows = frame(spark, schema, (1, "a"), (2, "b"))
    store.append_new("t", rows, ["id"], "B1", schema)
    result = store.append_new("t", rows.where("false"), ["id"], "B1", schema)
    assert (result.n_in, result.n_new, result.n_skipped) == (0, 0, 0) and store.read("t").count() == 0
    assert store.batch_ids("t") == ["B1"]
    assert store.append_new("t", rows, ["id"], "B2", schema).n_new == 2


DATED = "id int, day date, state string"


def test_only_the_months_of_the_batch_are_compared(spark, folder):
    import datetime as dt

    store, keys = ParquetStore(spark, folder), ["id", "day"]
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    first = frame(spark, DATED, *[(n, day, "old") for n, day in enumerate(days)], (9, None, "old"))
    assert store.append_new("t", first, keys, "B1", DATED, month_of="day", null_safe=True).n_new == 4
    more = frame(spark, DATED, (1, days[1], "new"), (0, days[1], "new"), (9, None, "new"))
    assert store.append_new("t", more, keys, "B2", DATED, month_of="day", null_safe=True).n_new == 1
    assert rows_of(store.read("t").where("state = 'new'").select("id", "day")) == [(0, days[1])]
    history = store.read_existing("t", DATED, by_month=True).where("etl_month IN ('2024-02')")
    plan = plan_of(history)
    assert "PartitionFilters: [isnotnull(etl_month" in plan or "etl_month#" in plan.split("PartitionFilters: [")[1]
    assert all("etl_month=2024-02" in path for path in history.inputFiles()) or len(history.inputFiles()) > 0
    assert store.append_new("t", more.where("false"), keys, "B2", DATED, month_of="day").n_new == 0
    assert store.read("t").count() == 4
    with pytest.raises(ValueError):
        store.append_new("t", more, ["id"], "B3", DATED, month_of="day")


def test_snapshot_replaces_and_casts(spark, folder):
    store = ParquetStore(spark, folder)
    store.snapshot("d", frame(spark, "k int, extra int", (1, 1), (2, 2)), "B1", "k bigint")
    result = store.snapshot("d", frame(spark, "k int, extra int", (3, 3)), "B2", "k bigint")
    assert result.n_new == 1
    table = store.read("d")
    assert table.columns == ["k", "etl_loaded_at", "etl_batch_id"]
    assert dict(table.dtypes)["k"] == "bigint" and table.first().k == 3


def test_missing_table_is_none_and_other_errors_are_raised(spark, folder):
    store = ParquetStore(spark, folder)
    assert store.read_existing("nothing", "id int") is None
    with open(f"{folder}/broken", "w") as file:
        file.write("this is no table")
    with pytest.raises(Exception):
        store.read_existing("broken", "id int").collect()


def test_a_first_load_that_wrote_nothing_reads_as_empty(spark, folder, tmp_path):
    (tmp_path / "t").mkdir()
    store = ParquetStore(spark, folder)
    assert store.read_existing("t", "id int").count() == 0
    assert store.append_new("t", frame(spark, "id int", (1,)), ["id"], "B1", "id int").n_new == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_same_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("abc")) for i in range(40)]
    schema = "id int, t string"
    whole = ParquetStore(spark, str(tmp_path / "whole"))
    whole.append_new("t", frame(spark, schema, *rows), ["id"], "B", schema)
    split = ParquetStore(spark, str(tmp_path / "split"))
    for number in range(3):
        part = rng.sample(rows, 25)
        split.append_new("t", frame(spark, schema, *part), ["id"], f"B{number}", schema)
    split.append_new("t", frame(spark, schema, *rows), ["id"], "B9", schema)
    assert rows_of(split.read("t").select("id", "t")) == rows_of(whole.read("t").select("id", "t"))


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_without_checkpoint_folder_the_warehouse_is_shared():
    class Session:
        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod({"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "hdfs://n/wh/"}.get)

    from lumbung.sources import stores

    seen, given = [], stores.delete_at_end
    stores.delete_at_end = lambda spark, path: seen.append(path)
    try:
        Session.conf.get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "hdfs://n/wh/"}.get(name, default))
        assert shared_folder(Session, "x").startswith("hdfs://n/wh/lumbung/x-") and len(seen) == 1
    finally:
        stores.delete_at_end = given


def test_jdbc_tables_are_looked_for_in_the_own_schema(spark):
    mysql, postgres = (JdbcStore(spark, f"jdbc:{kind}://h/db", {}) for kind in ("mysql", "postgresql"))
    assert mysql.exists_sql("t").endswith("table_name = 't' AND table_schema = DATABASE()")
    assert postgres.exists_sql("t").endswith("AND table_schema = CURRENT_SCHEMA")


def test_file_drops_are_loaded_once(spark, tmp_path):
    drops, store = tmp_path / "drops", ParquetStore(spark, str(tmp_path / "store"))
    schema = "id int, state string"

    def drop(*rows):
        frame(spark, schema, *rows).coalesce(1).write.mode("append").json(str(drops))

    def load():
        append_file_drops(
            spark, str(drops), "json", schema, store, "t", ["id"], str(tmp_path / "checkpoint")
        )

    drop((1, "a"), (2, "b"), (2, "b"))
    load()
    drop((2, "late"), (3, "c"))
    load()
    load()
    assert rows_of(store.read("t").select("id", "state")) == [(1, "a"), (2, "b"), (3, "c")]


def test_jdbc_options_bound_the_connections(spark):
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    store = JdbcStore(
        spark, "jdbc:mysql://h/db", {"user": "u"}, num_partitions=4,
        column_types={"dim_paket": "jenis_paket VARCHAR(50)"}, partitioning={"t": split},
    )
    options = store.write_options("dim_paket", "overwrite")
    assert options["numPartitions"] == "4" and options["batchsize"] == "500"
    assert options["truncate"] == "true"
    assert options["createTableColumnTypes"] == "jenis_paket VARCHAR(50)"
    assert "truncate" not in store.write_options("olah_ulasan", "append")
    assert store.read_options("t")["partitionColumn"] == "id"
    assert "partitionColumn" not in store.read_options("other")


def test_jdbc_column_types():
    types = jdbc_column_types("id string, day date, paid decimal(15,2), komentar string", 100, ["komentar"])
    assert types == (
        "id VARCHAR(100), day DATE, paid DECIMAL(15,2), komentar VARCHAR(1000),"
        " etl_loaded_at TIMESTAMP, etl_batch_id VARCHAR(100)"
    )


class StoreOfFolders(JdbcStore):
    """The JDBC policy with folders in place of a database."""

    def path(self, table):
        return f"{self.url}/{table}"

    def exists(self, table):
        import os

        return os.path.exists(self.path(table))

    def read(self, table):
        return self.spark.read.parquet(self.path(table))

    def write(self, table, df, mode):
        df.write.mode(mode).parquet(self.path(table))


def test_jdbc_policy_resumes_a_failed_batch(spark, folder):
    store = StoreOfFolders(spark, folder, {})
    schema = "id int, state string"
    rows = frame(spark, schema, (1, "a"), (2, "b"), (3, "c"))
    store.append_new("t", rows.where("id = 1"), ["id"], "B1", schema)
    store.append_new("t", rows.where("id < 3"), ["id"], "B2", schema)  # as if it had failed here
    result = store.append_new("t", rows, ["id"], "B2", schema)
    assert (result.n_in, result.n_new) == (3, 2)
    assert rows_of(store.read("t").select("id")) == [(1,), (2,), (3,)]
    assert store.snapshot("d", rows, "B1", schema).n_new == 3

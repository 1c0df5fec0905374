"""Small runs work on several event tables at once, broadcast bridges and ask no filter that could save nothing."""

from dataclasses import replace

import pytest
from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F
from test_plans import AS_OF, GIVEN, sources
from test_runs import contents, given_tables
from test_steps_at_size import GIVEN as EVENTS
from test_steps_at_size import bridges

from lumbung.operators.key_index import key_zones
from lumbung.plans import PipelineConfig, run_pipeline
from lumbung.plans import pipeline as steps
from lumbung.plans.staging import EVENT_TABLES, build_events
from lumbung.sources import stores
from lumbung.sources.paths import bytes_below
from lumbung.sources.stores import ParquetStore


def test_event_tables_of_a_small_run_go_together_and_end_in_the_same_rows(spark, tmp_path, monkeypatch):
    tables, used, each = given_tables(spark, str(tmp_path / "given"), GIVEN, "parquet"), [], steps._each

    def seen(items, action, config, at_once=None):
        items = list(items)
        if {*items} & {*EVENT_TABLES, *steps.FACTS}:
            used.append(at_once)
        return each(items, action, config, at_once)

    monkeypatch.setattr(steps, "_each", seen)
    small = PipelineConfig(tables, str(tmp_path / "small"), "B1", AS_OF)
    large = replace(small, folder=str(tmp_path / "large"), small_bytes=0)
    run_pipeline(spark, small)
    assert {n for n in used if n is not None} == {4}
    used.clear()
    run_pipeline(spark, large)
    assert {n for n in used if n is not None} == {1}
    assert contents(spark, small) == contents(spark, large)


def test_bytes_are_those_of_all_files_below(spark, tmp_path):
    for name, size in (("a/b/x", 5), ("a/c", 7), ("d", 11)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(bytes(size))
    assert [bytes_below(spark, f"{tmp_path}/{name}") for name in ("a", "a/c", "*", "none")] == [12, 7, 23, 0]


@pytest.mark.parametrize("hashed, join", [(True, "ShuffledHashJoin"), (False, "BroadcastHashJoin")])
def test_small_bridges_are_broadcast_where_they_may_be(spark, folder, hashed, join):
    given, store = sources(spark, **EVENTS), ParquetStore(spark, folder)
    users, courses = (store.write(str(n), df) for n, df in enumerate(bridges(given)))
    events = build_events("olah_hasil_latihan", given, users, courses, replace(AS_OF, hash_bridges=hashed))
    assert plan_of(events).count(join) == 2 and events.count() == 2


def test_filters_are_asked_only_where_they_can_save_rows(spark, folder, monkeypatch):
    schema, store = "id string", ParquetStore(spark, folder)

    def ids(low, high):
        return spark.range(low, high).select(F.format_string("E-%06d", "id").alias("id"))

    store.append_new("t", ids(0, 100), ["id"], "B1", schema, key_index=True)
    asked, with_keys = [], stores.batches_with_keys
    monkeypatch.setattr(stores, "batches_with_keys", lambda *a: asked.append(1) or with_keys(*a))
    assert store.append_new("t", ids(50, 250), ["id"], "B2", schema, key_index=True).n_new == 150
    assert not asked
    assert store.append_new("t", ids(90, 92), ["id"], "B3", schema, key_index=True).n_new == 0
    assert asked


def test_zones_of_text_are_read_once(spark):
    rows = frame(spark, "id string", ("A-1",), ("A-3",), ("B-2",), (None,))
    zones = key_zones(rows, ["id"])
    assert "LocalTableScan" in plan_of(zones) or "Scan ExistingRDD" in plan_of(zones)
    assert rows_of(zones) == [("", None, None, 1, 1), ("A-", "A-1", "A-3", 0, 2), ("B-", "B-2", "B-2", 0, 1)]

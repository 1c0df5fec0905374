"""Runs that stop half-way, and events that come too early."""

import datetime as dt
from dataclasses import replace

import pytest
from helpers import rows_of
from test_plans import AS_OF, GIVEN, sources

from lumbung.plans import PipelineConfig, run_pipeline
from lumbung.plans.ledger import RunLedger
from lumbung.plans.schemas import DIMENSIONS, FACTS, SOURCES, STAGING
from lumbung.sources.readers import TableSource
from lumbung.sources.stores import ParquetStore


def given_tables(spark, folder, rows, format="parquet"):
    given, store = sources(spark, **rows), ParquetStore(spark, folder)
    tables = {}
    for code in SOURCES:
        tables[code] = {}
        for name in SOURCES[code]:
            if f"{code}_{name}" in rows:
                path = f"{folder}/{code}-{name}"
                given[code][name].coalesce(1).write.format(format).save(path)
                tables[code][name] = TableSource(name, SOURCES[code][name], format, path)
    assert store.root == folder
    return tables


def contents(spark, config):
    stores = {"staging": STAGING, "warehouse": {**DIMENSIONS, **FACTS}}
    return {
        name: rows_of(config.target(spark, part).read(name).drop("etl_loaded_at"))
        for part, names in stores.items()
        for name in names
    }


@pytest.fixture(scope="module")
def unbroken(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("unbroken"))
    tables = given_tables(spark, f"{folder}/given", GIVEN, "json")
    config = PipelineConfig(tables, f"{folder}/run", "B1", AS_OF)
    summary = run_pipeline(spark, config)
    return tables, contents(spark, config), sorted((r.table, r.n_in, r.n_new) for r in summary.results)


class Stopped(Exception):
    pass


class StoppingLedger(RunLedger):
    """Fails in the named step, before or after its record is made."""

    stop, recorded = "", True

    def run(self, step, action, versions=dict):
        if step != self.stop:
            return super().run(step, action, versions)
        if self.recorded:
            super().run(step, action, versions)
        else:
            action()
        raise Stopped(step)


@pytest.mark.parametrize(
    "stop, recorded",
    [("transform_staging", True), ("load_warehouse", False)],
)
def test_a_run_that_is_started_again_ends_in_the_rows_of_one(spark, tmp_path, unbroken, stop, recorded):
    tables, want, metrics = unbroken
    config = PipelineConfig(tables, str(tmp_path / "run"), "B1", AS_OF)
    first = StoppingLedger(spark, f"{config.folder}/ledger", "B1")
    first.stop, first.recorded = stop, recorded
    with pytest.raises(Stopped):
        run_pipeline(spark, config, first)
    second = RunLedger(spark, f"{config.folder}/ledger", "B1")
    summary = run_pipeline(spark, config, second)
    done = first.repeated if recorded else [s for s in first.repeated if s != stop]
    assert second.skipped == done and stop not in (second.repeated if recorded else second.skipped)
    assert contents(spark, config) == want
    assert sorted((r.table, r.n_in, r.n_new) for r in summary.results) == metrics


def test_steps_are_repeated_where_another_batch_has_replaced_their_tables(spark, tmp_path):
    store, done = ParquetStore(spark, f"{tmp_path}/work"), []

    def run(ledger, batch):
        ledger.begin(True)
        versions = lambda: {"t": store.version("t")}
        ledger.run("one", lambda: done.append("one"))
        ledger.run("two", lambda: store.write("t", spark.range(3)) and None, versions)
        ledger.run("three", lambda: done.append("three"))

    for batch in ("B1", "B1", "B2", "B1"):
        ledger = RunLedger(spark, f"{tmp_path}/ledger", batch)
        run(ledger, batch)
    assert (ledger.skipped, ledger.repeated) == (["one"], ["two", "three"])
    assert done == ["one", "three", "one", "three", "three"]


def test_a_finished_batch_starts_over(spark, tmp_path):
    config = PipelineConfig({}, str(tmp_path), "B1", AS_OF)
    ledger = RunLedger(spark, f"{tmp_path}/ledger", "B1")
    ledger.begin(True)
    assert ledger.run("a", lambda: None) == []
    again = RunLedger(spark, f"{tmp_path}/ledger", "B1")
    again.begin(True)
    again.run("a", lambda: pytest.fail("done already"))
    assert again.skipped == ["a"] and again.repeated == []
    again.finish()
    for ledger, resume in ((RunLedger(spark, f"{tmp_path}/ledger", "B1"), True), (RunLedger(spark, f"{tmp_path}/ledger", "B1"), False)):
        ledger.begin(resume)
        ledger.run("a", lambda: None)
        assert ledger.repeated == ["a"]
    assert config.resume


EARLY = ("R8", "M9", "PRG1", dt.datetime(2024, 1, 12, 9), None, 300, "web")
AHEAD = ("R9", "M1", "PRG1", dt.datetime(2025, 6, 1, 9), None, 60, "web")
BROKEN = ("R7", "M1", "PRG1", dt.datetime(2024, 1, 12, 9), None, -5, "web")


def test_events_that_come_too_early_are_admitted_once(spark, tmp_path):
    name = "olah_aktivitas_belajar"
    days = {"B1": AS_OF, "B2": AS_OF, "B3": replace(AS_OF, as_of=dt.date(2025, 7, 1))}
    base = {k: rows for k, rows in GIVEN.items() if k != "zb_riwayat_belajar"}
    newcomer = ("M9", "Dewi", "d@mail.id", "SMA", 10, "Bali", dt.date(2024, 1, 1))
    known = {**base, "zb_member": [*base["zb_member"], newcomer]}
    deliveries = {
        "B1": {**base, "zb_riwayat_belajar": [EARLY, AHEAD, BROKEN]},
        "B2": {**known, "zb_riwayat_belajar": []},  # the user comes, the event is not delivered again
        "B3": {**known, "zb_riwayat_belajar": [EARLY]},  # delivered again, and the other's day has come
    }
    seen = {}
    for batch, rows in deliveries.items():
        rows = {k: r for k, r in rows.items() if r}
        tables = given_tables(spark, f"{tmp_path}/{batch}", rows)
        config = PipelineConfig(tables, f"{tmp_path}/run", batch, days[batch], quarantine=True)
        run_pipeline(spark, config)
        facts = config.target(spark, "warehouse").read("fakta_aktivitas_belajar")
        held = config.work(spark, "quarantine").read(name)
        seen[batch] = (
            sorted(r[0] for r in facts.select("id_aktivitas_sumber").collect() if r[0].startswith("ZB")),
            {(r.id_aktivitas, r.reject_reason, r.first_batch) for r in held.collect() if (r.id_aktivitas or "").startswith("ZB")},
        )
    late = ("ZB-AK-R9", "tanggal_aktivitas is missing or in the future", "B1")
    broken = ("ZB-AK-R7", "durasi_belajar_menit is out of range", "B1")
    assert seen["B1"] == ([], {("ZB-AK-R8", "id_pengguna_global is missing", "B1"), late, broken})
    assert seen["B2"] == (["ZB-AK-R8"], {late, broken})
    assert seen["B3"] == (["ZB-AK-R8", "ZB-AK-R9"], {broken})

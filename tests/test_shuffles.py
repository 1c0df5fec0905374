"""What queries shuffle and write on their way: narrow, one event table after another, and gone with the write."""

import datetime as dt
import os

from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from test_plans import AS_OF, sources
from test_steps_at_size import GIVEN, bridges

from lumbung.plans.schemas import STAGING
from lumbung.plans.staging import EVENT_TABLES, build_events
from lumbung.sources.shuffles import SETTING, freed_shuffles
from lumbung.sources.stores import ParquetStore
from workload import star_queries as star

DAY = dt.date(2024, 1, 10)


def shuffle_files(spark):
    here = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {
        name
        for folder in here
        for _, _, names in os.walk(folder)
        for name in names
        if name.startswith("shuffle_") and name.endswith(".data")
    }


def test_a_write_leaves_no_shuffle_behind(spark, folder):
    before, setting = shuffle_files(spark), spark.conf.get(SETTING)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    written = ParquetStore(spark, folder).write("t", rows)
    assert shuffle_files(spark) <= before
    assert written.count() == 7 and rows.count() == 7
    assert spark.conf.get(SETTING) == setting


def test_the_setting_lasts_as_long_as_a_step_runs(spark):
    setting = spark.conf.get(SETTING)
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            assert spark.conf.get(SETTING) == "true"
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING) == setting


def test_columns_that_are_read_are_those_of_the_whole_rows(spark):
    rows = [
        # one event comes twice, and the row that counts is not the one of the least score or day
        ("1", "M1", "P1", DAY + dt.timedelta(n), 900 - 10 * n, 10) for n in range(5)
    ] + [("1", "M2", "P1", DAY - dt.timedelta(1), 5, 10), ("2", "M2", "P1", DAY, 700, 10), ("3", "M9", "P1", DAY, 1, 1)]
    given = sources(spark, **{**GIVEN, "zb_nilai_tryout": rows})
    names = [part.split()[0] for part in STAGING["olah_hasil_latihan"].replace("(5,2)", "").split(", ")]
    whole = build_events("olah_hasil_latihan", given, *bridges(given), AS_OF)
    assert whole.columns == names and whole.count() == 2
    for read in (["tanggal_latihan"], ["status_lulus", "id_pengguna_global"], ["id_hasil"], ["nilai_standar"]):
        some = build_events("olah_hasil_latihan", given, *bridges(given), AS_OF, columns=read)
        assert set(some.columns) == set(read)
        assert rows_of(some) == rows_of(whole.select(*some.columns))
    days = build_events("olah_hasil_latihan", given, *bridges(given), AS_OF, columns=["tanggal_latihan"])
    assert "nilai" not in plan_of(days).split("Exchange")[1]


def test_event_tables_are_looked_up_by_platform_id_alone(spark):
    given = sources(spark, **GIVEN)
    plan = plan_of(build_events("olah_hasil_latihan", given, *bridges(given), AS_OF))
    # the name of the platform is only in the bridges, where it becomes the id
    assert not [line for line in plan.splitlines() if "Exchange" in line and "nama_platform" in line]


def test_dimensions_read_one_column_of_each_event_table():
    columns = star._read_columns(star.DIMENSION_VALUES)
    assert columns["olah_hasil_latihan"] == {"tanggal_latihan"}
    assert columns["olah_transaksi"] == {"tanggal_transaksi", "nama_paket_standar", "metode_bayar_standar"}
    assert set(columns) < set(EVENT_TABLES)


def test_event_tables_are_staged_one_by_one_and_narrow(spark, folder, monkeypatch):
    written = []

    class Store(ParquetStore):
        def write(self, table, df):
            written.append((table, df.columns))
            return super().write(table, df)

    monkeypatch.setattr(star, "ParquetStore", lambda spark, root: Store(spark, root))
    monkeypatch.setattr(star, "derived_sources", lambda spark, sf_dir: sources(spark, **GIVEN))
    fact = star._fact(spark, folder, "fakta_pendaftaran_program", star.OPTIONS)
    assert fact.count() == 0
    events = [(table, columns) for table, columns in written if table in EVENT_TABLES]
    assert sorted(events) == [
        ("olah_aktivitas_belajar", ["tanggal_aktivitas"]),
        ("olah_hasil_latihan", ["tanggal_latihan"]),
        ("olah_transaksi", ["tanggal_transaksi"]),
        ("olah_ulasan", ["tanggal_ulasan"]),
    ]

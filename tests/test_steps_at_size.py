"""Steps whose shuffles and memory have to grow no faster than the input."""

import datetime as dt

from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F
from test_plans import AS_OF, DAY, sources

from lumbung.functions import global_id, packed_id, unpacked_id
from lumbung.operators.profile import exact_median, score_stats
from lumbung.plans.staging import build_events, course_bridge, held_events, rejected_events, user_bridge
from workload.star_queries import DIMENSION_EVENTS, _read_once

LATER = dt.date(2024, 7, 1)
GIVEN = {
    "zb_member": [(f"M{n}", f"N{n}", f"n{n}@x.id", "SMA", 10, "Bali", DAY) for n in range(3)],
    "zb_program_belajar": [("P1", "Title", "Fisika", "SMA", "beginner", "Guru")],
    # id, member, program, day, score, questions
    "zb_nilai_tryout": [
        *(("1", "M1", "P1", DAY, 500, 10) for _ in range(40)),
        *((str(n), "nobody", "P1", DAY, 500, 10) for n in range(10, 60)),
        ("2", "M1", "nothing", DAY, 500, 10),
        ("3", "M1", "P1", LATER, 500, 10),
        ("3", "M2", "P1", DAY, 600, 10),
        ("4", "nobody", "nothing", DAY, 500, 10),
        (None, "M1", "P1", DAY, 500, 10),
        (None, "M1", "P1", DAY, 500, 10),
    ],
}


def bridges(given):
    return user_bridge(given), course_bridge(given)


def test_packed_ids_are_the_same_ids_in_the_same_order(spark):
    texts = [(None,), ("USR-",), ("USR-7",), ("USR-0aff",), ("other",), ("USR-ABC",)]
    ids = frame(spark, "id string", *texts)
    ids = ids.unionByName(spark.range(300).select(global_id("USR-", F.col("id").cast("string")).alias("id")))
    packed = ids.withColumn("packed", packed_id("USR-", F.col("id")))
    assert packed.where(~unpacked_id("USR-", F.col("packed")).eqNullSafe(F.col("id"))).isEmpty()
    whole = packed.where(F.length("id") == 36)
    assert whole.agg(F.max(F.length("packed"))).first()[0] == 17
    by_text, by_bytes = (whole.orderBy(c).select("id").collect() for c in ("id", "packed"))
    assert len(by_text) == 300 and by_text == by_bytes


def test_events_are_resolved_without_being_sorted(spark):
    given = sources(spark, **GIVEN)
    events = build_events("olah_hasil_latihan", given, *bridges(given), AS_OF)
    plan = plan_of(events)
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    shown = rows_of(events.select("id_hasil", "id_pengguna_global", "tanggal_latihan"))
    ids = {n: f"USR-{row[0]}" for n, row in enumerate(_hashes(spark))}
    assert shown == [("ZB-HL-1", ids[1], DAY), ("ZB-HL-3", ids[2], DAY)]


def _hashes(spark):
    return spark.range(3).select(F.upper(F.md5(F.md5(F.format_string("n%d@x.id", "id"))))).collect()


def test_rejects_are_counted_before_the_lookups(spark):
    given = sources(spark, **GIVEN)
    report = rejected_events("olah_hasil_latihan", given, *bridges(given), AS_OF)
    plan = plan_of(report)
    assert "__n" in plan and plan.index("Join") < plan.rindex("HashAggregate")
    assert [row[1:] for row in rows_of(report)] == [
        ("id_hasil is missing", 2),
        ("id_kelas_global is missing", 1),
        ("id_pengguna_global is missing", 51),
        ("tanggal_latihan is missing or in the future", 1),
    ]


def test_rejects_count_as_often_as_the_bridges_have_their_keys(spark):
    given = sources(spark, **GIVEN)
    users, courses = bridges(given)
    report = rejected_events("olah_hasil_latihan", given, users.unionByName(users), courses.unionByName(courses), AS_OF)
    assert [row[2] for row in rows_of(report)] == [8, 2, 101, 4]


def test_held_events_look_their_keys_up_once(spark):
    given = sources(spark, **GIVEN)
    held = held_events("olah_hasil_latihan", given, *bridges(given), "B1", AS_OF)
    assert plan_of(held).count("Join") == 2
    shown = rows_of(held.select("id_hasil", "reject_reason", "first_batch"))
    # event 3 passes by its other row; rows without an id are shown once
    assert shown.count((None, "id_hasil is missing", "B1")) == 1
    assert len(shown) == 50 + 1 + 1 + 1 and not [row for row in shown if row[0] in ("ZB-HL-1", "ZB-HL-3")]


def test_medians_shuffle_no_row_by_its_group(spark):
    rows = spark.range(30_001).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"),
        (F.col("id") * 1.5).alias("score"),
    )
    assert "SortMergeJoin" not in plan_of(exact_median(rows, "score", ["source"]))
    stats = rows_of(score_stats(rows, "score", ["source"]))
    assert stats == [
        (None, 10_000, 22_500.75, 22_500.75),
        ("a", 10_001, 22_500.0, 22_500.0),
        ("b", 10_000, 22_499.25, 22_499.25),
    ]


def test_tables_with_one_reader_are_not_written():
    assert _read_once(DIMENSION_EVENTS.values()) == {"olah_hasil_latihan"}
    assert _read_once([("a",), ("a", "b")]) == {"b"}

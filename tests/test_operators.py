import datetime as dt

from helpers import final_plan, frame, plan_of, rows_of
from pyspark.sql import functions as F

from lumbung.functions import surrogate_key

from lumbung.operators import (
    Rule,
    at_least,
    build_fact,
    dedup_by_key,
    distinct_values,
    lookup,
    not_after,
    pick_per_entity,
    quality_gate,
    reject_report,
    required,
    salted_lookup,
    tag_rejects,
    union_all,
    within,
)
from lumbung.operators.facts import Flag, KeyLookup

EVENTS = "id string, user string, day date, score int"
DAY = dt.date(2024, 1, 10)


def dirty_events(spark):
    return frame(
        spark, EVENTS,
        ("ok", "u", DAY, 50),
        ("bounds", "u", DAY, 0),
        ("top", "u", DAY, 100),
        ("future", "u", dt.date(2024, 1, 11), 50),
        ("undated", "u", None, 50),
        ("low", "u", DAY, -1),
        ("high", "u", DAY, 101),
        ("unmeasured", "u", DAY, None),
        ("nobody", None, DAY, 50),
        (None, "u", DAY, 50),
        ("twice wrong", None, None, 200),
    )


RULES = lambda: [not_after("day", DAY), within("score", 0, 100), required("id"), required("user")]


def test_gate_and_rejects_are_a_partition(spark):
    events = dirty_events(spark)
    passed = quality_gate(events, RULES())
    assert {r.id for r in passed.collect()} == {"ok", "bounds", "top"}
    tagged = tag_rejects(events, RULES())
    assert tagged.where("reject_reason is null").count() == 3
    report = dict(rows_of(reject_report(events, RULES())))
    assert report == {
        "day is missing or in the future": 3,
        "score is out of range": 3,
        "id is missing": 1,
        "user is missing": 1,
    }


def test_gate_uses_today_without_a_day(spark):
    tomorrow = dt.date.today() + dt.timedelta(days=2)
    df = frame(spark, "day date", (DAY,), (tomorrow,))
    assert quality_gate(df, [not_after("day", None)]).count() == 1


def test_at_least_and_custom_rule(spark):
    df = frame(spark, "x int", (-1,), (0,), (5,), (None,))
    odd = Rule("x is even", F.col("x") % 2 == 1)
    assert rows_of(quality_gate(df, [at_least("x", 0), odd])) == [(5,)]


def test_gate_is_pushed_into_the_scan(spark, folder):
    frame(spark, EVENTS, ("a", "u", DAY, 1)).write.parquet(f"{folder}/e")
    plan = plan_of(quality_gate(spark.read.parquet(f"{folder}/e"), RULES()).select("id"))
    assert "LessThanOrEqual(day,2024-01-10)" in plan and "GreaterThanOrEqual(score,0)" in plan


def test_union_matches_by_name_and_keeps_duplicates(spark):
    a = frame(spark, "x int, y string", (1, "a"))
    b = frame(spark, "y string, x int", ("a", 1), ("b", 2))
    assert rows_of(union_all([a, b])) == [(1, "a"), (1, "a"), (2, "b")]
    assert rows_of(distinct_values([(a, "y"), (b, "y")], "v")) == [("a",), ("b",)]


def test_dedup_keeps_the_least_row_whatever_the_input_order(spark):
    rows = [("a", 2, None), ("a", 1, "z"), ("a", 1, None), ("b", 5, "x"), ("b", 5, "x")]
    for order in (rows, rows[::-1]):
        df = frame(spark, "k string, n int, t string", *order).repartition(4)
        assert rows_of(dedup_by_key(df, ["k"])) == [("a", 1, None), ("b", 5, "x")]
        assert rows_of(dedup_by_key(df, ["k"], ["t"])) == [("a", 1, None), ("b", 5, "x")]
    assert rows_of(dedup_by_key(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_picked_attributes_belong_to_one_row(spark):
    df = frame(
        spark, "who string, at int, name string, town string",
        ("a", 2, "second", "X"), ("a", 1, "first", None), ("b", 1, "only", "Y"),
    )
    got = pick_per_entity(df, "who", ["at"], ["name", "town"])
    assert rows_of(got) == [("a", "first", None), ("b", "only", "Y")]


def test_a_key_with_many_copies_is_cut_down_before_the_shuffle(spark):
    copies = spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    least = dedup_by_key(copies, ["k"])
    plan = plan_of(least)
    before, after = plan.split("Exchange hashpartitioning(k", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert least.count() == 6667 + 1
    assert least.where("k = 'hot'").first().id == 1


PEOPLE = [("p1", "1", "USR-1"), ("p1", "2", "USR-2"), ("p2", "1", "USR-3")]
VISITS = [("p1", "1", 10), ("p1", "1", 11), ("p1", "9", 12), ("p2", "1", 13), ("p2", None, 14)]
ON = {"platform": "platform", "native": "native"}


def people_and_visits(spark):
    people = frame(spark, "platform string, native string, gid string", *PEOPLE)
    return frame(spark, "platform string, native string, n int", *VISITS), people


def test_lookup_left_and_inner(spark):
    visits, people = people_and_visits(spark)
    left = lookup(visits, people, ON, {"gid": "who"})
    assert left.columns == ["platform", "native", "n", "who"]
    assert {(r.n, r.who) for r in left.collect()} == {
        (10, "USR-1"), (11, "USR-1"), (12, None), (13, "USR-3"), (14, None),
    }
    inner = lookup(visits, people, ON, ["gid"], "inner")
    assert {r.n for r in inner.collect()} == {10, 11, 13}


def test_salted_lookup_equals_lookup(spark):
    visits, people = people_and_visits(spark)
    for how in ("left", "inner"):
        for hot_keys in (1, 2, 100):
            salted = salted_lookup(visits, people, ON, ["gid"], how, hot_keys=hot_keys, salts=4)
            assert rows_of(salted) == rows_of(lookup(visits, people, ON, ["gid"], how))


def skewed(spark):
    """A third of the rows has one key, a third has none, the rest are spread."""
    visits = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 5000)
        .cast("bigint")
        .alias("native"),
        "id",
    )
    people = spark.range(5000).select(F.col("id").alias("native"), (F.col("id") * 2).alias("gid"))
    return visits, people


def test_salted_lookup_spreads_a_hot_key_and_the_missing_key(spark):
    visits, people = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_lookup(visits, people, {"native": "native"}, ["gid"], salts=16)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60000 and max(sizes) < 20000
        assert joined.where("native = 7 and gid = 14").count() == 20000 + 4
        # rows without a key are never shuffled; the others are 40000 in 8 partitions
        spread = salted_lookup(visits, people, {"native": "native"}, ["gid"], "inner")
        parts = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == 40000 and max(parts) <= 2 * 40000 / 8
        assert "isnotnull(native" in plan_of(spread)
        plan = plan_of(joined)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # the only broadcast is the list of hot keys, cut to its limit
        assert plan.count("BroadcastExchange") <= 2 and "TakeOrderedAndProject" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_adaptive_execution_splits_the_hot_key_of_a_plain_lookup(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    visits, people = skewed(spark)
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup(visits, people, {"native": "native"}, ["gid"])
        assert "skew=true" in final_plan(joined)
        assert joined.where("gid is not null").count() == 40000
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_fact_keys_are_null_where_the_dimension_has_no_row(spark):
    events = frame(
        spark, "id string, day date, device string, minutes int",
        ("a", DAY, "mobile", 5), ("b", DAY, "tidak diketahui", 6), ("c", None, None, 7),
    )
    dimensions = {
        "days": frame(spark, "k bigint, d date", (1, DAY)),
        "devices": frame(spark, "dk bigint, name string", (2, "mobile")),
    }
    lookups = [
        KeyLookup("days", "k", "day", "d", size_bounded=True),
        KeyLookup("devices", "dk", "device", "name"),
    ]
    columns = [Flag("event", F.col("id")), Flag("long", (F.col("minutes") > 5).cast("int"))]
    expected = [(1, 2, "a", 0), (1, None, "b", 1), (None, None, "c", 1)]
    for hot_keys in (0, 8):
        fact = build_fact(events, dimensions, lookups, columns, hot_keys=hot_keys)
        assert fact.columns == ["k", "dk", "event", "long"]
        assert sorted(rows_of(fact), key=lambda r: r[2]) == expected


def test_a_key_that_is_always_there_is_computed_without_a_join(spark):
    events = frame(spark, "id string, who string, minutes int", ("a", "USR-1", 5), ("b", "USR-2", 6), ("c", None, 7))
    people = frame(spark, "who string", ("USR-1",), ("USR-2",)).select(
        surrogate_key(F.col("who")).alias("pk"), "who"
    )
    lookups = [KeyLookup("people", "pk", "who", "who", always_there=True)]
    columns = [Flag("event", F.col("id"))]
    computed = build_fact(events, {"people": people}, lookups, columns)
    plan = plan_of(computed)
    assert "Join" not in plan and "Exchange" not in plan
    assert rows_of(computed) == rows_of(build_fact(events, {"people": people}, lookups, columns, computed_keys=None))

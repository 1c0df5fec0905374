import math
import random
import statistics
from decimal import Decimal
from fractions import Fraction

import pytest
from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F

from lumbung.functions.exact import exact_sum, rounded_quotient
from lumbung.operators.checks import domain_rule, duplicate_keys, orphan_keys, row_count_rule
from lumbung.operators.profile import (
    activity_stats,
    exact_median,
    conversion,
    histogram,
    month_profile,
    pattern_share,
    score_stats,
    subject_scores,
    table_counts,
    timeline,
    top_values,
    value_range,
)

SCORES = "source string, score decimal(5,2)"


def test_top_values_break_ties_by_value_and_limit_before_the_shuffle(spark):
    df = frame(spark, "s string, x string", *[("a", x) for x in "zzyyxw"], ("b", "q"))
    top = top_values(df, "x", 3, ["s"])
    assert rows_of(top) == [("a", "w", 1, 3), ("a", "y", 2, 1), ("a", "z", 2, 2), ("b", "q", 1, 1)]
    assert "WindowGroupLimit" in plan_of(top)
    assert [r.x for r in top_values(df, "x", 2).collect()] == ["y", "z"]


def test_score_stats(spark):
    values = ["10.00", "20.00", "20.00", "40.50", None]
    df = frame(spark, SCORES, *[("a", v and Decimal(v)) for v in values])
    assert rows_of(score_stats(df, "score", ["source"])) == [("a", 4, 22.625, 20.0)]


def test_score_stats_keep_all_digits_of_any_type(spark):
    values = [87.34, 87.34, 123456.0, 0.002, None]
    df = frame(spark, "s string, x double", *[("a", x) for x in values], (None, 2.5), ("b", None))
    assert rows_of(score_stats(df, "x", ["s"])) == [(None, 1, 2.5, 2.5), ("a", 4, round(sum(values[:4]) / 4, 4), 87.34)]
    wide = frame(spark, "s string, x decimal(20,3)", *[("a", Decimal(x)) for x in ("1.125", "9000000.5", "2")])
    assert rows_of(score_stats(wide, "x", ["s"]))[0][3] == 2.0
    whole = frame(spark, "s string, x bigint", *[("a", x) for x in (1, 2, 3, 10**15)])
    assert rows_of(score_stats(whole, "x", ["s"]))[0][3] == 2.5


@pytest.mark.parametrize("kind", ["spread", "one outlier", "one value", "two values"])
def test_exact_median_where_the_bounds_are_narrow_and_where_they_fail(spark, kind):
    rng = random.Random(kind)
    made = {
        "spread": [rng.gauss(0, 1) for _ in range(4001)],
        "one outlier": [rng.random() for _ in range(3000)] + [1e300],
        "one value": [7.25] * 900 + [-1.0] * 10,
        "two values": [1.0] * 500 + [2.0] * 500,
    }[kind]
    df = spark.createDataFrame([("a", x) for x in made], "s string, x double").repartition(5)
    for accuracy in (10_000, 10):
        assert exact_median(df, "x", ["s"], accuracy).first().median == statistics.median(made)


def test_histogram_closes_the_last_bin(spark):
    df = frame(spark, "s string, x int", *[("a", x) for x in (0, 1, 9, 10)], ("b", 5), ("b", None))
    assert rows_of(histogram(df, "x", 10, ["s"])) == [
        ("a", 0, 1), ("a", 1, 1), ("a", 9, 2), ("b", 0, 1),
    ]


def test_months_without_rows_are_zero(spark):
    df = frame(spark, "s string, d string", ("a", "2024-04-01"), ("a", "2023-12-01"))
    df = df.selectExpr("s", "cast(d as date) as d")
    rows = {r.month: (r.n_rows, r.peak_pct) for r in month_profile(df, "d", ["s"]).collect()}
    assert rows[4] == rows[12] == (1, 50.0) and rows[1] == (0, 50.0) and len(rows) == 12
    assert rows_of(timeline(df, "d", ["s"])) == [("a", "2023-12", 1), ("a", "2024-04", 1)]


def test_shares(spark):
    df = frame(
        spark, "s string, place string, package string, paid int",
        ("a", "DKI Jakarta", "Gratis", 0), ("a", "Bali", "Pro", 5), ("a", None, "Free", 1),
    )
    pattern = "Jawa|Jakarta|Banten|Yogyakarta"
    assert rows_of(pattern_share(df, "place", pattern, ["s"])) == [("a", 3, 33.3333)]
    paid = conversion(df, "package", ["Gratis", "Free"], "paid", ["s"])
    assert rows_of(paid) == [("a", 3, 33.3333, 66.6667)]


def test_activity_stats_and_range(spark):
    df = frame(spark, "s string, u int, m int", ("a", 1, 5), ("a", 1, 7), ("a", 2, None))
    assert rows_of(activity_stats(df, "m", "u", ["s"], 5, 20)) == [("a", 3, 2, 6.0, True, 1.5)]
    assert rows_of(value_range(df, "m", ["s"])) == [("a", 5, 7)]


def test_checks(spark):
    df = frame(spark, "s string, d string", ("a", "ios"), ("a", "tv"), ("a", None), ("b", "web"))
    assert rows_of(domain_rule(df, "d", ["ios", "web"], ["s"])) == [
        ("a", None, 1, "not allowed"), ("a", "tv", 1, "not allowed"),
        ("a", "web", 0, "absent"), ("b", "ios", 0, "absent"),
    ]
    assert rows_of(domain_rule(df, "d", ["ios", "web", "tv"])) == [(None, 1, "not allowed")]
    rule = row_count_rule(df, df.where("d = 'web'"), "s", ("n", "m"))
    assert rows_of(rule) == [("a", 3, 0, True), ("b", 1, 1, True)]
    assert rows_of(duplicate_keys(df, ["s"])) == [("a", 3)]
    parents = frame(spark, "p string", ("ios",), ("web",))
    assert rows_of(orphan_keys(df, "d", parents, "p")) == [("tv", 1)]
    assert rows_of(table_counts({"x": df, "y": parents})) == [("x", 4), ("y", 2)]


def _mean(values, unit=1):
    """Half up at the fourth digit, away from zero, of the decimal numbers as written."""
    total = sum(map(Fraction, map(repr, values)))
    steps = abs(total) / len(values) / unit * 10**4
    return math.copysign((2 * steps + 1) // 2, total) / 10**4


@pytest.mark.parametrize("partitions", [1, 3, 8, 20])
def test_means_do_not_depend_on_the_order_of_rows(spark, partitions):
    rng = random.Random(1)
    values = {
        "tie": [53.2999, 53.28] * 3,  # the mean is 53.28995
        "digits": [rng.uniform(0, 100) for _ in range(3000)],
        "wide": [rng.choice([1e-9, 1.0, 1e12, -1e12, 0.1]) for _ in range(3000)],
        "negative": [-0.00005, -0.00015, -0.0001],
        "zero": [0.0, -0.0, 0.00004],
    }
    rows = [(k, v, i % 7) for k, vs in values.items() for i, v in enumerate(vs)] + [("empty", None, 1)]
    rng.shuffle(rows)
    df = frame(spark, "s string, x double, u int", *rows).repartition(partitions)
    got = {r.s: r.mean for r in score_stats(df, "x", ["s"]).collect()}
    assert got == {k: _mean(vs) for k, vs in values.items()}
    tenths = {r.s: (r.mean, r.median) for r in score_stats(df, "x", ["s"], F.lit(10.0)).collect()}
    assert tenths["tie"] == (_mean(values["tie"], 10), 5.329) and tenths["digits"][0] == _mean(values["digits"], 10)
    stats = {r.s: r.mean_duration for r in activity_stats(df, "x", "u", ["s"], 5, 20).collect()}
    assert stats == {**got, "empty": None}
    courses = frame(spark, "c int, t string", *[(u, "math") for u in range(7)])
    by_subject = subject_scores(df.where("s = 'digits'"), courses, ("u", "c"), "t", ["math"], "x").collect()
    assert [tuple(r) for r in by_subject] == [("math", 3000, _mean(values["digits"]))]


def test_sums_of_other_types_are_exact_too(spark):
    df = frame(spark, "i bigint, d decimal(10,3), f float", (2**62, Decimal("0.125"), 0.1), (2**62, Decimal("0.250"), 0.2))
    kinds = {name: df.schema[name].dataType for name in df.columns}
    row = df.agg(*(exact_sum(F.col(name), kind).alias(name) for name, kind in kinds.items())).first()
    assert (row.i, row.d, row.f) == (2**63, Decimal("0.375"), Decimal("0.3"))


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e300, 1e-19])
def test_a_value_beyond_the_guard_is_an_error(spark, value):
    df = frame(spark, "s string, x double", ("a", 1.0), ("a", value))
    with pytest.raises(Exception, match="no exact sum"):
        score_stats(df, "x", ["s"]).collect()


def test_quotients_are_rounded_once(spark):
    cases = [("0.00005", 1, 0.0001), ("0.00004999999999999", 1, 0.0), ("-0.00005", 1, -0.0001), ("1", 3, 0.3333),
             ("2", 3, 0.6667), ("5", 0, None), (None, 2, None)]
    df = frame(spark, "t string, n bigint, want double", *cases).withColumn("t", F.col("t").cast("decimal(38,18)"))
    rows = df.select("want", rounded_quotient(F.col("t"), F.col("n")).alias("got")).collect()
    assert all(r.got == r.want for r in rows)

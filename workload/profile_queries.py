"""Profiling and constraint checks (Q1-Q18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.checks import (
    domain_rule,
    duplicate_keys,
    orphan_keys,
    row_count_rule,
)
from lumbung.operators.conform import union_all
from lumbung.operators.profile import (
    activity_stats,
    conversion,
    histogram,
    month_profile,
    pattern_share,
    score_stats,
    scorecard,
    subject_scores,
    table_counts,
    timeline,
    top_values,
    value_counts,
    value_range,
)
from lumbung.operators.report_state import (
    state_activity,
    state_conversion,
    state_counts,
    state_histogram,
    state_months,
    state_patterns,
    state_range,
    state_stats,
    state_timeline,
    state_top,
)
from lumbung.sources.report_states import ReportStates
from lumbung.sources.stores import shared_folder
from workload.registry import ORACLES, query, table

# Three given tables as the events of three sources.
EVENTS = (
    "(SELECT 'orders' AS source, o_custkey AS user_id, o_orderdate::DATE AS day,"
    " o_orderpriority AS label, (o_orderkey % 10001)::DECIMAL(7,2) / 100 AS raw FROM orders"
    " UNION ALL SELECT 'lines', l_suppkey, l_shipdate::DATE, l_returnflag, l_quantity FROM lineitem"
    " UNION ALL SELECT 'events', user_id, ts::DATE, event_type, event_id % 97 FROM events)"
)
SCORED = f"(SELECT * EXCLUDE (raw), round(raw, 2)::DECIMAL(5,2) AS score FROM {EVENTS})"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name, source, user, day, label, score):
        return table(spark, sf_dir, name).select(
            F.lit(source).alias("source"),
            F.col(user).alias("user_id"),
            F.col(day).cast("date").alias("day"),
            F.col(label).alias("label"),
            score.cast("decimal(5,2)").alias("score"),
        )

    hundredths = (F.col("o_orderkey") % 10001).cast("decimal(7,2)") / 100
    return union_all(
        [
            part("orders", "orders", "o_custkey", "o_orderdate", "o_orderpriority", hundredths),
            part("lineitem", "lines", "l_suppkey", "l_shipdate", "l_returnflag", F.col("l_quantity")),
            part("events", "events", "user_id", "ts", "event_type", F.col("event_id") % 97),
        ]
    )


@query(
    "value_counts", f"SELECT source, label, count(*) AS n_rows FROM {SCORED} GROUP BY ALL"
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_events(spark, sf_dir), "label", ["source"])


@query(
    "top_k_values",
    "SELECT source, user_id, n_rows, row_number() OVER (PARTITION BY source ORDER BY n_rows DESC,"
    f" user_id)::INTEGER AS rank FROM (SELECT source, user_id, count(*) AS n_rows FROM {SCORED}"
    " GROUP BY ALL) QUALIFY rank <= 10",
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(_events(spark, sf_dir), "user_id", 10, ["source"])


@query(
    "pattern_share",
    "SELECT source, count(*) AS n_rows, round(sum(CASE WHEN regexp_matches(label,"
    " 'LOW|HIGH|sign|^[AN]$') THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS share_pct"
    f" FROM {SCORED} GROUP BY source",
)
def patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_share(_events(spark, sf_dir), "label", "LOW|HIGH|sign|^[AN]$", ["source"])


@query(
    "month_concentration",
    "SELECT s.source, m.month, coalesce(c.n_rows, 0) AS n_rows, s.peak_pct FROM"
    " (SELECT source, round(sum(CASE WHEN month(day) IN (4, 5, 6) THEN 1 ELSE 0 END) * 100.0"
    f" / count(*), 4) AS peak_pct FROM {SCORED} GROUP BY source) s"
    " CROSS JOIN (SELECT range::INTEGER AS month FROM range(1, 13)) m"
    f" LEFT JOIN (SELECT source, month(day) AS month, count(*) AS n_rows FROM {SCORED}"
    " GROUP BY ALL) c ON s.source = c.source AND m.month = c.month",
)
def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_profile(_events(spark, sf_dir), "day", ["source"])


@query(
    "score_stats",
    "SELECT source, count(*) AS n_rows, round(sum(score)::DOUBLE / count(*), 4) AS mean,"
    f" round(median(score::DOUBLE), 4) AS median FROM {SCORED} GROUP BY source",
)
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_stats(_events(spark, sf_dir), "score", ["source"])


PRICES = (
    "(SELECT 'orders' AS source, o_totalprice AS price FROM orders"
    " UNION ALL SELECT 'lines', l_extendedprice FROM lineitem"
    " UNION ALL SELECT 'thousandths', o_custkey / 1000.0::DOUBLE FROM orders)"
)


@query(
    "score_stats_prices",
    "SELECT source, count(*) AS n_rows, round(sum(price)::DOUBLE / count(*), 4) AS mean,"
    f" round(median(price::DOUBLE), 4) AS median FROM {PRICES} GROUP BY source",
)
def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 on values of any size and number of digits."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    parts = [
        orders.select(F.lit("orders").alias("source"), F.col("o_totalprice").cast("double").alias("price")),
        lines.select(F.lit("lines").alias("source"), F.col("l_extendedprice").cast("double").alias("price")),
        orders.select(F.lit("thousandths").alias("source"), (F.col("o_custkey") / F.lit(1000.0)).alias("price")),
    ]
    return score_stats(union_all(parts), "price", ["source"])


@query(
    "histogram",
    "SELECT source, CASE WHEN high = low THEN 0 ELSE least(floor((score::DOUBLE - low)"
    " / (high - low) * 30), 29) END::INTEGER AS bin, count(*) AS n_rows"
    f" FROM {SCORED} JOIN (SELECT source, min(score)::DOUBLE AS low, max(score)::DOUBLE AS high"
    f" FROM {SCORED} GROUP BY source) USING (source) GROUP BY ALL",
)
def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(_events(spark, sf_dir), "score", 30, ["source"])


@query(
    "timeline",
    f"SELECT source, strftime(day, '%Y-%m') AS month, count(*) AS n_rows FROM {SCORED} GROUP BY ALL",
)
def by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(_events(spark, sf_dir), "day", ["source"])


@query(
    "conversion",
    "SELECT source, count(*) AS n_rows, round(sum(CASE WHEN label NOT IN ('5-LOW', 'A', 'view')"
    " THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS paid_package_pct,"
    " round(sum(CASE WHEN score > 0 THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS paid_amount_pct"
    f" FROM {SCORED} GROUP BY source",
)
def paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion(_events(spark, sf_dir), "label", ["5-LOW", "A", "view"], "score", ["source"])


@query(
    "min_max",
    f"SELECT source, min(day) AS low, max(day) AS high FROM {SCORED} GROUP BY source",
)
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_range(_events(spark, sf_dir), "day", ["source"])


@query(
    "duration_stats",
    "SELECT source, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,"
    " round(sum(score)::DOUBLE / count(score), 4) AS mean_duration,"
    " sum(score)::DOUBLE / count(score) BETWEEN 5 AND 30 AS in_target,"
    f" round(count(*) / count(DISTINCT user_id), 4) AS events_per_user FROM {SCORED}"
    " GROUP BY source",
)
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_stats(_events(spark, sf_dir), "score", "user_id", ["source"], 5, 30)


@query(
    "scorecard",
    "SELECT source, count(DISTINCT user_id) AS n_users,"
    " round(sum(score)::DOUBLE / count(*), 4) AS mean,"
    " round(sum(CASE WHEN label NOT IN ('5-LOW', 'A', 'view') THEN 1 ELSE 0 END) * 100.0"
    " / count(*), 4) AS paid_package_pct,"
    " round(sum(CASE WHEN month(day) IN (4, 5, 6) THEN 1 ELSE 0 END) * 100.0 / count(*), 4)"
    " AS peak_pct, round(sum(CASE WHEN regexp_matches(label, 'LOW|HIGH') THEN 1 ELSE 0 END)"
    f" * 100.0 / count(*), 4) AS share_pct FROM {SCORED} GROUP BY source",
)
def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return scorecard(
        [
            activity_stats(events, "score", "user_id", ["source"], 5, 30).select("source", "n_users"),
            score_stats(events, "score", ["source"]).select("source", "mean"),
            conversion(events, "label", ["5-LOW", "A", "view"], "score", ["source"]).select(
                "source", "paid_package_pct"
            ),
            month_profile(events, "day", ["source"]).where("month = 1").select("source", "peak_pct"),
            pattern_share(events, "label", "LOW|HIGH", ["source"]).select("source", "share_pct"),
        ],
        "source",
    )


@query(
    "row_count_rule",
    "SELECT status, n_lines, n_orders, n_lines >= n_orders AS holds FROM"
    " (SELECT l_linestatus AS status, count(*) AS n_lines FROM lineitem GROUP BY 1) FULL JOIN"
    " (SELECT o_orderstatus AS status, count(*) AS n_orders FROM orders GROUP BY 1)"
    " USING (status) WHERE n_lines IS NOT NULL AND n_orders IS NOT NULL"
    " UNION ALL SELECT o_orderstatus, 0, count(*), false FROM orders WHERE o_orderstatus NOT IN"
    " (SELECT l_linestatus FROM lineitem) GROUP BY 1",
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_linestatus", "status")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status")
    return row_count_rule(lines, orders, "status", ("n_lines", "n_orders"))


@query(
    "domain_rule",
    "SELECT l_linestatus, l_returnflag AS value, count(*) AS n_rows, 'not allowed' AS problem"
    " FROM lineitem WHERE l_returnflag NOT IN ('A', 'N', 'X') GROUP BY ALL"
    " UNION ALL SELECT DISTINCT l_linestatus, 'X', 0, 'absent' FROM lineitem",
)
def domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return domain_rule(lines, "l_returnflag", ["A", "N", "X"], ["l_linestatus"])


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}"
        for name in ("customer", "supplier", "part", "orders", "lineitem", "events")
    ),
)
def all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "supplier", "part", "orders", "lineitem", "events")
    return table_counts({name: table(spark, sf_dir, name) for name in names})


@query(
    "pk_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL"
    " HAVING count(*) > 1",
)
def pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    "SELECT l_partkey, count(*) AS n_rows FROM lineitem WHERE l_partkey NOT IN"
    " (SELECT c_custkey FROM customer) GROUP BY l_partkey",
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, customers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    return orphan_keys(lines, "l_partkey", customers, "c_custkey")


@query(
    "subject_scores",
    "SELECT p_type, count(*) AS n_rows, round(sum(l_quantity) / count(*), 4) AS mean"
    " FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')"
    " GROUP BY p_type",
)
def by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subject_scores(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part"),
        ("l_partkey", "p_partkey"),
        "p_type",
        ["SMALL", "LARGE", "PROMO"],
        "l_quantity",
    )


# ---- reports kept up to date: the same results, from the states of batches


def _kept(spark: SparkSession, sf_dir: str, keys: list[str], measure: str | None = None) -> DataFrame:
    """The merged state of the events, which arrive by year; one year is delivered twice, and some are merged early."""
    events = _events(spark, sf_dir)
    year = F.coalesce(F.year("day"), F.lit(0))
    states = ReportStates(spark, shared_folder(spark, "states"), keys, measure)
    states.add("early", events.where(year < 1994))
    states.add("late", events.where(year >= 1994))  # too many, replaced below
    states.add("middle", events.where((year >= 1994) & (year < 1997)))
    states.compact(keep=["late"])
    states.add("late", events.where(year >= 1997))
    return states.merged()


@query("kept_value_counts", ORACLES["value_counts"])
def kept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_counts(_kept(spark, sf_dir, ["source", "label", "day"]), "label", ["source"])


@query("kept_top_values", ORACLES["top_k_values"])
def kept_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_top(_kept(spark, sf_dir, ["source", "user_id"]), "user_id", 10, ["source"])


@query("kept_pattern_share", ORACLES["pattern_share"])
def kept_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_patterns(_kept(spark, sf_dir, ["source", "label"]), "label", "LOW|HIGH|sign|^[AN]$", ["source"])


@query("kept_months", ORACLES["month_concentration"])
def kept_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_months(_kept(spark, sf_dir, ["source", "day"]), "day", ["source"])


@query("kept_score_stats", ORACLES["score_stats"])
def kept_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_stats(_kept(spark, sf_dir, ["source", "score"], "score"), "score", ["source"])


@query("kept_histogram", ORACLES["histogram"])
def kept_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_histogram(_kept(spark, sf_dir, ["source", "score"]), "score", 30, ["source"])


@query("kept_timeline", ORACLES["timeline"])
def kept_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_timeline(_kept(spark, sf_dir, ["source", "day"]), "day", ["source"])


@query("kept_conversion", ORACLES["conversion"])
def kept_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _kept(spark, sf_dir, ["source", "label", "score"])
    return state_conversion(state, "label", ["5-LOW", "A", "view"], "score", ["source"])


@query("kept_min_max", ORACLES["min_max"])
def kept_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_range(_kept(spark, sf_dir, ["source", "day"]), "day", ["source"])


@query("kept_duration_stats", ORACLES["duration_stats"])
def kept_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_activity(_kept(spark, sf_dir, ["source", "user_id"], "score"), "user_id", ["source"], 5, 30)

"""Reports from counts that are kept, not from events (Q1-Q8, Q12, Q13).

A state counts the rows of one batch by some keys: groups, and the values a report counts.
With a measure it also has its number of values, exact sum, least and greatest value.  All of
these merge, so the states of batches, merged in any order, are the state of all their rows,
and a report over many batches reads states alone.  A state has as many rows as its keys have
different values, however many events there were.

The reports give the rows of their namesakes in ``profile``.  A NULL key is a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.exact import exact_sum, rounded_quotient
from lumbung.operators.profile import _join_groups

#: ranges of about as many different values each, of which the median's own are ordered
MEDIAN_RANGES = 256


def partial_state(rows: DataFrame, keys: Sequence[str], measure: str | None = None) -> DataFrame:
    """(keys, n[, n_values, total, low, high]) of one batch's rows."""
    parts = [F.count(F.lit(1)).alias("n")]
    if measure is not None:
        kind = rows.schema[measure].dataType
        parts += [
            F.count(measure).alias("n_values"),
            exact_sum(F.col(measure), kind).alias("total"),
            F.min(measure).alias("low"),
            F.max(measure).alias("high"),
        ]
    return rows.groupBy(*keys).agg(*parts)


def merged_state(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of all rows, from the rows of several states of the same keys and measure."""
    how = {"n": F.sum, "n_values": F.sum, "total": F.sum, "low": F.min, "high": F.max}
    return states.groupBy(*keys).agg(*(how[c](c).alias(c) for c in states.columns if c not in keys))


def state_counts(state: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Q1."""
    return state.groupBy(*by, column).agg(F.sum("n").alias("n_rows"))


def state_top(state: DataFrame, column: str, k: int, by: Sequence[str]) -> DataFrame:
    """Q2: the ``k`` most frequent values per group; ties go to the lesser value."""
    order = Window.partitionBy(*by).orderBy(F.desc("n_rows"), F.asc(column))
    return state_counts(state, column, by).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def state_share(test: Column, digits: int = 4) -> Column:
    """An aggregate: the percentage of rows for which ``test``, on keys of the state, is true."""
    return F.round(F.sum(F.when(test, F.col("n")).otherwise(F.lit(0))) * F.lit(100.0) / F.sum("n"), digits)


def state_patterns(state: DataFrame, column: str, pattern: str, by: Sequence[str]) -> DataFrame:
    """Q3."""
    return state.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), state_share(F.col(column).rlike(pattern)).alias("share_pct")
    )


def state_months(
    state: DataFrame, date_column: str, by: Sequence[str], peak: Sequence[int] = (4, 5, 6)
) -> DataFrame:
    """Q4."""
    month = F.month(date_column)
    wide = state.groupBy(*by).agg(
        *(F.sum(F.when(month == m, F.col("n")).otherwise(F.lit(0))).alias(f"m{m}") for m in range(1, 13)),
        state_share(month.isin(*peak)).alias("peak_pct"),
    )
    pairs = F.array(*(F.struct(F.lit(m).alias("month"), F.col(f"m{m}").alias("n_rows")) for m in range(1, 13)))
    return wide.select(*by, F.inline(pairs), "peak_pct")


def state_stats(state: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Q5: mean and exact median of ``column``, which is both a key and the measure of the state."""
    rows = state.where(F.col(column).isNotNull())
    n = F.sum("n")
    stats = rows.groupBy(*by).agg(n.alias("n_rows"), rounded_quotient(F.sum("total"), n).alias("mean"))
    medians = weighted_median(rows, column, "n", by)
    return _join_groups(stats, medians, by).select(*by, "n_rows", "mean", F.round("median", 4).alias("median"))


def weighted_median(counts: DataFrame, column: str, n: str, by: Sequence[str]) -> DataFrame:
    """The median of each group, where a row of ``counts`` stands for ``n`` equal values.

    Approximate quantiles of the different values cut a group into ranges; the rows in each
    are counted, and only the values of the one or two ranges with the middle ranks are ordered.
    """
    value = F.col(column).cast("double")
    rows = counts.where(F.col(column).isNotNull()).groupBy(*by, value.alias("__v")).agg(F.sum(n).alias("__n"))
    quantiles = [k / MEDIAN_RANGES for k in range(1, MEDIAN_RANGES)]
    cuts = rows.groupBy(*by).agg(
        F.percentile_approx("__v", quantiles, F.lit(10_000)).alias("__cuts"), F.sum("__n").alias("__all")
    )
    # which range a value is in depends on the value alone, so equal values are never parted
    placed = _join_groups(rows, cuts, by).select(
        *by, "__v", "__n", F.size(F.filter("__cuts", lambda cut: cut < F.col("__v"))).alias("__range")
    )
    upto = F.sum("__n").over(
        Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranges = placed.groupBy(*by, "__range").agg(F.sum("__n").alias("__n")).withColumn("__upto", upto)
    first, last = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    middle = (
        _join_groups(ranges, cuts.drop("__cuts"), by)
        .withColumns({"__before": F.col("__upto") - F.col("__n"), "__first": first, "__last": last})
        .where("__before < __last AND __upto >= __first")
        .select(*by, "__range", "__before", "__first", "__last")
    )
    inside = _join_groups(placed, middle, [*by, "__range"])
    order = Window.partitionBy(*by, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("__upto", F.col("__before") + F.sum("__n").over(order))

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("__upto") >= F.col(rank), F.col("__v")))

    return ranked.groupBy(*by).agg(((at("__first") + at("__last")) / 2).alias("median"))


def state_histogram(state: DataFrame, column: str, bins: int, by: Sequence[str]) -> DataFrame:
    """Q6: equal-width bins between the least and the greatest value per group; the last one is closed."""
    values = state.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("__value"), "n")
    ranges = values.groupBy(*by).agg(F.min("__value").alias("__low"), F.max("__value").alias("__high"))
    width = F.col("__high") - F.col("__low")
    position = F.floor((F.col("__value") - F.col("__low")) / width * F.lit(bins))
    bin_number = F.when(width == 0, F.lit(0)).otherwise(F.least(position, F.lit(bins - 1)))
    return (
        _join_groups(values, ranges, by).groupBy(*by, bin_number.cast("int").alias("bin")).agg(F.sum("n").alias("n_rows"))
    )


def state_timeline(state: DataFrame, date_column: str, by: Sequence[str]) -> DataFrame:
    """Q7: rows per ``yyyy-MM``."""
    return state.groupBy(*by, F.date_format(date_column, "yyyy-MM").alias("month")).agg(F.sum("n").alias("n_rows"))


def state_conversion(
    state: DataFrame, package: str, free_labels: Sequence[str], amount: str, by: Sequence[str]
) -> DataFrame:
    """Q8, by a state with the package and the amount (or whether it is above zero, as 0 or 1) as keys."""
    free = F.coalesce(F.col(package).isin(*free_labels), F.lit(False))
    return state.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        state_share(~free).alias("paid_package_pct"),
        state_share(F.col(amount) > 0).alias("paid_amount_pct"),
    )


def state_range(state: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Q12: least and greatest value of a key of the state."""
    return state.groupBy(*by).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def state_activity(state: DataFrame, user: str, by: Sequence[str], low: float, high: float) -> DataFrame:
    """Q13, by a state with the user as a key and the duration as its measure.

    Users are counted exactly: the state is first merged to one row for each.
    """
    users = merged_state(state.select(*by, user, "n", "n_values", "total"), [*by, user])
    total, timed = F.sum("total"), F.sum("n_values")
    return users.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        F.count(user).alias("n_users"),
        rounded_quotient(total, timed).alias("mean_duration"),
        F.coalesce((total.cast("double") / timed).between(low, high), F.lit(False)).alias("in_target"),
        F.round(F.sum("n") / F.count(user), 4).alias("events_per_user"),
    )

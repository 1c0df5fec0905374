"""Profiling of the conformed tables (Q1-Q7, Q8, Q12-Q15, Q18).

The source tag is a group key, so one pass serves all sources.  Every operator
counts or sums by key first; what is ranked, joined or binned afterwards is
the small aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lumbung.functions.exact import exact_sum, rounded_quotient
from lumbung.operators.conform import union_all


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Q1: how often each value occurs."""
    return df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n_rows"))


def top_values(df: DataFrame, column: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Q2: the ``k`` most frequent values per group; ties go to the lesser value.

    The rank filter is applied per task before the shuffle, so no task gets
    more than ``k`` rows per group and upstream task.
    """
    counts = value_counts(df, column, by)
    if not by:
        return counts.orderBy(F.desc("n_rows"), F.asc(column)).limit(k)
    order = Window.partitionBy(*by).orderBy(F.desc("n_rows"), F.asc(column))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share(test: Column, digits: int = 4) -> Column:
    """The percentage of rows for which ``test`` is true (NULL counts as false)."""
    hits = F.sum(F.when(test, F.lit(1)).otherwise(F.lit(0)))
    return F.round(hits * F.lit(100.0) / F.count(F.lit(1)), digits)


def pattern_share(df: DataFrame, column: str, pattern: str, by: Sequence[str]) -> DataFrame:
    """Q3: the share of values that contain a match of ``pattern``."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(F.col(column).rlike(pattern)).alias("share_pct"),
    )


def month_profile(
    df: DataFrame, date_column: str, by: Sequence[str], peak: Sequence[int] = (4, 5, 6)
) -> DataFrame:
    """Q4: rows per month of the year with zeros filled in, and the peak share.

    One row per group leaves the aggregation; the twelve months are columns of
    it until they are unpivoted, so no calendar has to be joined.
    """
    month = F.month(date_column)
    wide = df.groupBy(*by).agg(
        *(F.count(F.when(month == m, F.lit(1))).alias(f"m{m}") for m in range(1, 13)),
        share(month.isin(*peak)).alias("peak_pct"),
    )
    pairs = F.array(
        *(F.struct(F.lit(m).alias("month"), F.col(f"m{m}").alias("n_rows")) for m in range(1, 13))
    )
    return wide.select(*by, F.inline(pairs), "peak_pct")


def score_stats(df: DataFrame, column: str, by: Sequence[str], unit: Column | None = None) -> DataFrame:
    """Q5: mean and exact median of a score of any numeric type.

    ``unit`` is what one point of the result is in the column's scale, the same for all
    rows of a group; the exact sum and the median are divided by it, once.

    A decimal of six digits at most bounds the number of values by its type (a
    decimal(5,2) between 0 and 100 has 10,001), so there the rows are counted per value
    first and the median buffer of a group is small.  Any other type goes through
    ``exact_median``, which never holds all values of a group, and sums the rows as they are.
    """
    kind = df.schema[column].dataType
    rows = df.where(F.col(column).isNotNull()).withColumn("__unit", F.lit(1) if unit is None else unit)
    rows = rows.withColumn("__unit", F.col("__unit").cast("decimal(20,4)"))
    per = F.max("__unit")
    if isinstance(kind, DecimalType) and kind.precision <= 6:
        counts = rows.groupBy(*by, column).agg(
            F.count(F.lit(1)).alias("__n"),
            exact_sum(F.col(column), kind).alias("__sum"),
            per.alias("__unit"),
        )
        n = F.sum("__n")
        mean = rounded_quotient(F.sum("__sum"), n * per).alias("mean")
        median = F.percentile(F.col(column).cast("double"), F.lit(0.5), F.col("__n")) / per.cast("double")
        return counts.groupBy(*by).agg(n.alias("n_rows"), mean, F.round(median, 4).alias("median"))
    n = F.count(F.lit(1))
    mean = rounded_quotient(exact_sum(F.col(column), kind), n * per).alias("mean")
    stats = rows.groupBy(*by).agg(n.alias("n_rows"), mean, per.alias("__unit"))
    medians = exact_median(rows, column, by).withColumnRenamed("median", "__median")
    median = F.round(F.col("__median") / F.col("__unit").cast("double"), 4).alias("median")
    return _join_groups(stats, medians, by).select(*by, "n_rows", "mean", median)


def exact_median(df: DataFrame, column: str, by: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """The median of each group without ordering all of its values.

    An approximate quantile a little below and one a little above the middle
    bound a narrow range.  Counting the rows below and inside it proves whether
    the middle ranks lie in it (else the group's whole range is taken), and only
    the values of that range are ordered.
    """
    value = F.col(column).cast("double")
    rows = df.where(F.col(column).isNotNull()).select(*by, value.alias("__v"))
    margin = 2.0 / accuracy
    bounds = rows.groupBy(*by).agg(
        F.percentile_approx("__v", F.lit(0.5 - margin), F.lit(accuracy)).alias("__low"),
        F.percentile_approx("__v", F.lit(0.5 + margin), F.lit(accuracy)).alias("__high"),
        F.min("__v").alias("__least"),
        F.max("__v").alias("__most"),
        F.count(F.lit(1)).alias("__all"),
    )
    # ranks of the two middle values, from 1
    first, last = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    placed = _join_groups(rows, bounds, by)
    proof = placed.groupBy(*by).agg(
        F.count_if(F.col("__v") < F.col("__low")).alias("__below"),
        F.count_if(F.col("__v") <= F.col("__high")).alias("__upto"),
    )
    holds = (F.col("__below") < first) & (F.col("__upto") >= last)
    ranges = _join_groups(bounds, proof, by).select(
        *by,
        F.when(holds, F.col("__low")).otherwise(F.col("__least")).alias("__low"),
        F.when(holds, F.col("__high")).otherwise(F.col("__most")).alias("__high"),
        F.when(holds, F.col("__below")).otherwise(F.lit(0)).alias("__below"),
        first.alias("__first"),
        last.alias("__last"),
    )
    inside = (
        _join_groups(rows, ranges, by)
        .where(F.col("__v").between(F.col("__low"), F.col("__high")))
        .groupBy(*by, "__v", "__below", "__first", "__last")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    upto = F.col("__below") + F.sum("__n").over(
        Window.partitionBy(*by).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = inside.withColumn("__upto", upto)

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("__upto") >= F.col(rank), F.col("__v")))

    return ranked.groupBy(*by).agg(((at("__first") + at("__last")) / 2).alias("median"))


def _join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join per-group values by group; a NULL group is a group.

    ``right`` has one row per group and groups are source tags, so it is broadcast: a
    shuffle by so few keys would bring all rows of a group into one task.
    """
    names = {name: f"__by{i}" for i, name in enumerate(by)}
    renamed = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(b)) for a, b in names.items()), F.lit(True))
    return left.join(F.broadcast(renamed), same).drop(*names.values())


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str]) -> DataFrame:
    """Q6: equal-width bins between the least and the greatest value per group.

    The last bin is closed.  Rows are counted per value before the ranges are
    joined to them; the optimizer chooses that join by the size of the two aggregates.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).cast("double").alias("__value"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranges = df.groupBy(*by).agg(
        F.min(F.col(column).cast("double")).alias("__low"),
        F.max(F.col(column).cast("double")).alias("__high"),
    )
    width = F.col("__high") - F.col("__low")
    position = F.floor((F.col("__value") - F.col("__low")) / width * F.lit(bins))
    bin_number = F.when(width == 0, F.lit(0)).otherwise(
        F.least(position, F.lit(bins - 1))
    )
    return (
        counts.join(ranges, list(by))
        .groupBy(*by, bin_number.cast("int").alias("bin"))
        .agg(F.sum("__n").alias("n_rows"))
    )


def timeline(df: DataFrame, date_column: str, by: Sequence[str]) -> DataFrame:
    """Q7: rows per ``yyyy-MM``."""
    return df.groupBy(*by, F.date_format(date_column, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def conversion(
    df: DataFrame, package: str, free_labels: Sequence[str], amount: str, by: Sequence[str]
) -> DataFrame:
    """Q8: the share of payments for a paid package, and with an amount above zero.

    A payment without a package label is not one for a free package.
    """
    free = F.coalesce(F.col(package).isin(*free_labels), F.lit(False))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(~free).alias("paid_package_pct"),
        share(F.col(amount) > 0).alias("paid_amount_pct"),
    )


def value_range(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Q12: least and greatest value."""
    return df.groupBy(*by).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def activity_stats(
    df: DataFrame, duration: str, user: str, by: Sequence[str], low: float, high: float
) -> DataFrame:
    """Q13: mean duration, whether it lies in a target range, and events per user.

    Users are counted from a table of one row per user and group, which is
    combined before its shuffle, so a very active user is no hot key.
    """
    kind = df.schema[duration].dataType
    per_user = df.groupBy(*by, user).agg(
        F.count(F.lit(1)).alias("__n"),
        exact_sum(F.col(duration), kind).alias("__sum"),
        F.count(duration).alias("__timed"),
    )
    total, timed = F.sum("__sum"), F.sum("__timed")
    mean = total.cast("double") / timed
    return per_user.groupBy(*by).agg(
        F.sum("__n").alias("n_rows"),
        F.count(user).alias("n_users"),
        rounded_quotient(total, timed).alias("mean_duration"),
        F.coalesce(mean.between(low, high), F.lit(False)).alias("in_target"),
        F.round(F.sum("__n") / F.count(user), 4).alias("events_per_user"),
    )


def scorecard(parts: Sequence[DataFrame], by: str) -> DataFrame:
    """Q14: one row per source out of several per-source aggregates."""
    return reduce(lambda a, b: a.join(b, by, "full"), parts)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q15: rows per table.  A count reads no column of a Parquet table."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    )


def subject_scores(
    results: DataFrame,
    courses: DataFrame,
    course_key: tuple[str, str],
    subject: str,
    subjects: Sequence[str],
    score: str,
) -> DataFrame:
    """Q18: scores by subject for some subjects.

    The results are summed per course before the join, so a course with very
    many results is one row in it.
    """
    result_key, catalogue_key = course_key
    kind = results.schema[score].dataType
    per_course = results.groupBy(result_key).agg(
        F.count(score).alias("__n"), exact_sum(F.col(score), kind).alias("__sum")
    )
    wanted = courses.where(F.col(subject).isin(*subjects)).select(
        F.col(catalogue_key).alias("__course"), subject
    )
    return (
        per_course.join(wanted, F.col(result_key) == F.col("__course"))
        .groupBy(subject)
        .agg(
            F.sum("__n").alias("n_rows"),
            rounded_quotient(F.sum("__sum"), F.sum("__n")).alias("mean"),
        )
    )

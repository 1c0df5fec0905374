"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Sources in code-point order (NULL last) get the weights 1, 2, 3, repeating, and
share all words of the corpus; a target stops at ``MOST_REPEATS`` times its source's
size and the excess is shared by weight among the others until none is above.
In closed form: with the sources ordered by limit over weight, the first one
whose limit is not below its share of what the earlier ones leave sets the level.

Within a source, documents stand in the order of a hash of their id and text;
walking over them again and again until the target is used up gives every copy
a place on the source's demand.  Each source has a weight schedule over training
time; its integral, scaled to the target, is the cumulative demand, and inverting
it turns a copy's place into its training position.  Documents are then sorted by
position, by ranges.

A running sum per source would put a hot source in one task, so it is made in two
steps: over hash ranges, as many as the square root of the row count, and within one.
Sources are ranked, and their limits summed up, in two such steps as well.

Defined cases: NULL text has size 0; a document of size 0 takes nothing and has no
position; rows that repeat take the words of each row; an empty table gives an
empty result.  Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.cluster import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3


@dataclass(frozen=True)
class Schedule:
    """A source's weight over training time: straight lines between (time, weight) points.

    Times go from 0 to 1 and weights are positive; only their proportions matter.
    """

    points: tuple[tuple[float, float], ...]

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """(share before, share after, time, weight, slope) of each line, for a total of 1."""
        area = sum((t - s) * (v + w) / 2 for (s, v), (t, w) in zip(self.points, self.points[1:]))
        out, before = [], 0.0
        for (s, v), (t, w) in zip(self.points, self.points[1:]):
            after = before + (t - s) * (v + w) / 2 / area
            out.append((before, after, s, v / area, (w - v) / (t - s) / area))
            before = after
        return out

    def time_of(self, share: Column) -> Column:
        """When the cumulative demand reaches ``share`` of its total: each line's integral is a parabola."""
        found = F.lit(None).cast("double")
        for before, _, time, weight, slope in self.pieces():
            more = share - F.lit(before)
            at = F.lit(time) + F.lit(2.0) * more / (
                F.lit(weight) + F.sqrt(F.lit(weight * weight) + F.lit(2.0 * slope) * more)
            )
            found = F.when(share >= F.lit(before), at).otherwise(found)  # the last line that has begun
        return found


#: the first source comes early in training, the second steadily, the third late, and so on
CURRICULUM = (
    Schedule(((0.0, 1.5), (1.0, 0.5))),
    Schedule(((0.0, 1.0), (1.0, 1.0))),
    Schedule(((0.0, 0.5), (1.0, 1.5))),
)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, at): the only step that reads texts, written once.

    ``source`` carries a mark before its name, so that NULL, marked alone, sorts last.
    """
    return cut(
        docs.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(
                F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
            ).alias("at"),
        )
    )


def range_digits(n: int) -> int:
    """Leading hex digits of the hash that name a range.

    There are about as many ranges as rows in one (both near the square root of
    ``n``), so neither step of the running sum grows faster than that in a task.
    """
    digits = 0
    while 256**digits < n:
        digits += 1
    return digits


def running(rows: DataFrame, order: Sequence[str], sums: dict[str, str], n: int) -> DataFrame:
    """``rows`` with the sum of each column of ``sums`` (new name: column) over all rows before.

    The ``n`` rows, no two of which have an equal ``order``, are written in about as many
    ranges as a range has rows; ranges are summed up first, then the rows in each.
    """
    parts = max(1, math.isqrt(n))
    placed = cut(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("part").agg(*(F.sum(column).alias(name) for name, column in sums.items()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    begins = totals.select(
        "part", *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_begin") for name in sums)
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(begins), "part")
        .withColumns(
            {name: F.col(f"{name}_begin") + F.coalesce(F.sum(column).over(inside), F.lit(0)) for name, column in sums.items()}
        )
        .drop("part", *(f"{name}_begin" for name in sums))
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, place, source_size, target) from (source, source_size); one row for each source."""
    sizes = cut(sizes)
    n = sizes.count()
    ranked = (
        running(sizes.withColumn("one", F.lit(1)), ["source"], {"place": "one"}, n)
        .withColumn("place", F.col("place") + 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))).cast("int") + 1))
        .withColumn("most", F.col("source_size") * MOST_REPEATS)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    limits = cut(running(ranked, ["ratio", "place"], {"most_before": "most", "weight_before": "weight"}, n))
    total = limits.agg(F.sum("source_size")).scalar()
    weight = limits.agg(F.sum("weight")).scalar()
    levels = limits.withColumn("level", (total - F.col("most_before")) / (weight - F.col("weight_before")))
    first = levels.where("level <= ratio").agg(F.min(F.struct("ratio", "place", "level"))["level"]).scalar()
    return levels.select(
        "source",
        F.col("place").cast("int").alias("place"),
        "source_size",
        F.least(F.col("most").cast("double"), F.col("weight") * first).alias("target"),
    )


def mixed(
    docs: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM, whole_documents: bool = False
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, positions) of every row of ``docs``.

    ``taken`` counts words over all copies.  The copy that reaches its source's
    target is taken in part; with ``whole_documents`` it is taken if at least half
    of it is within the target.  ``positions`` has the training time of each copy.
    """
    rows = sized(docs)
    digits = range_digits(rows.count())
    rows = rows.withColumn("range", F.substring("at", 1, digits) if digits else F.lit(""))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        ranges.withColumn("begin", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .drop("words")
        .join(targets, "source")
    )
    inside = Window.partitionBy("source", "range").orderBy("at", "doc_id", "size")
    placed = rows.join(begins, ["source", "range"]).withColumn(
        "begin",
        F.col("begin") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    budget = F.round("target").cast("long")
    copies = []
    for k in range(MOST_REPEATS):
        before = F.col("begin") + F.lit(k) * F.col("source_size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), budget - before))
        if whole_documents:
            part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        share = F.least((before + part / 2) / budget, F.lit(1.0))
        time = F.coalesce(
            *(
                F.when(F.pmod("place", F.lit(len(curriculum))) == (k + 1) % len(curriculum), schedule.time_of(share))
                for k, schedule in enumerate(curriculum)
            )
        )
        copies.append(F.when((F.col("size") > 0) & (part > 0), F.struct(part.alias("words"), time.alias("time"))))
    taken = F.filter(F.array(*copies), lambda copy: copy.isNotNull())
    return placed.withColumn("copies", taken).select(
        "doc_id",
        F.when(F.startswith("source", F.lit("+")), F.expr("substring(source, 2)")).alias("source"),
        "size",
        "source_size",
        "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda total, copy: total + copy["words"]).alias("taken"),
        F.transform("copies", lambda copy: copy["time"]).alias("positions"),
        "at",
    )


def in_training_order(mix: DataFrame, position: str = "position") -> DataFrame:
    """One row for each copy, sorted by position in ranges, so that part files are read in order."""
    return mix.withColumn(position, F.explode("positions")).orderBy(position, "doc_id")


def mixed_documents(docs: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM) -> DataFrame:
    """The rows of ``docs``, all columns, once for each whole copy that the mix takes.

    They are sorted by the copies' training positions, by ranges, so part files are read in that order.
    """
    mix = mixed(docs, curriculum, whole_documents=True)

    def marked(column: Column) -> Column:  # NULL is a source of its own
        return F.coalesce(F.concat(F.lit("+"), column), F.lit("-"))

    # equal rows have equal places in the order only up to their number, so they are joined by number
    keys = ["at", "id", "of"]
    same = Window.partitionBy(*keys).orderBy("at")
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),  # no name of theirs can clash
        F.md5(F.concat_ws("|", id_, F.coalesce("text", F.lit("")))).alias("at"),
        id_.alias("id"),
        marked(F.col("source")).alias("of"),
    ).withColumn("n", F.row_number().over(same))
    counts = (
        mix.where("taken > 0")
        .select("at", id_.alias("id"), marked(F.col("source")).alias("of"), "positions")
        .withColumn("n", F.row_number().over(same))
    )
    return (
        keyed.join(counts, [*keys, "n"])
        .select("row", "at", F.explode("positions").alias("position"))
        .orderBy("position", "at")
        .select("row.*")
    )

"""Merkle manifest of a dataset by checkpoint and recompute: only every few levels of the trees are stored.

Every row is a leaf of its group's tree, in the order of its key; ``Shape.fanout``
consecutive nodes hash to one of the next level (the last run may be shorter, even
one node) until one node is left, the group's root.  The group roots, by name, are
the leaves of one more tree, whose root stands for the dataset.

* ``write_manifest`` stores levels 0, ``every``, 2 ``every``, ... as blocks: a row holds the
  ``fanout ** every`` consecutive nodes below one node of the next stored level.  The levels
  between are computed where a block is folded to its one node and are not kept.
* ``proofs`` goes down the stored levels.  A block meets the path of the node above it, its
  missing interior nodes are made again from its own nodes, each node gets the siblings of
  its runs followed by that path, and the interior nodes are forgotten.

A node's place in its tree comes from a range sort of the leaves: the rows that stand
before it in its part, and the sizes of the parts before that, of which there are as many
as parts and groups together.  No window or task holds a whole group, and a row that
repeats is spread over parts by a number of its own.  Texts are read once, to be hashed;
only hashes and keys are shuffled.

Defined cases: a NULL field is ``-`` and differs from any text; rows with one key are in
the order of their hashes; a NULL key comes first in its tree and a NULL group first among
the groups; rows that repeat are leaves of their own; a lone leaf is its group's root and a
lone group root that of the dataset; an empty table has no root and no proofs.  Callers
name the columns that are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Shape:
    fanout: int = 8
    every: int = 3  # levels from one stored level to the next

    @property
    def block(self) -> int:
        return self.fanout**self.every


@dataclass(frozen=True)
class Manifest:
    """Where the stored levels are: those of the groups' trees, and those of the tree over the groups."""

    spark: SparkSession
    folder: str
    shape: Shape
    levels: int
    group_levels: int
    root: str | None

    def blocks(self, name: str, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}-{level}")


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Each field as its length in bytes, a colon and its value; NULL as ``-``."""
    texts = [field.cast("string") for field in fields]
    return hashed(
        *(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)
    )


def lower_cased(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def group_name(group: Column) -> Column:
    """A name that sorts NULL first and the others by their bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def write_manifest(leaves: DataFrame, folder: str, shape: Shape = Shape()) -> Manifest:
    """Store the trees over ``leaves`` (tree, key, hash, and what a proof shall carry in the struct ``row``).

    ``leaves`` is read twice and should be a stored table.
    """
    spark = leaves.sparkSession
    levels, roots = _grow(leaves, f"{folder}/nodes", shape)
    groups = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "hash", F.struct(F.col("tree").alias("name")).alias("row")
    )
    group_levels, top = _grow(groups, f"{folder}/groups", shape)
    root = top.first()  # one row at most
    return Manifest(spark, folder, shape, levels, group_levels, root and root["hash"])


def _grow(leaves: DataFrame, folder: str, shape: Shape) -> tuple[int, DataFrame]:
    """Store the levels below ``folder``; their number, and the one node (tree, hash) that each tree ends with."""
    spark = leaves.sparkSession
    nodes, largest = _placed(leaves, f"{folder}-order")
    level = 0
    while True:
        blocks = nodes.groupBy("tree", F.expr(f"pos DIV {shape.block}").alias("block"), "total").agg(
            F.sort_array(F.collect_list(F.struct("pos", "hash", "row"))).alias("nodes")  # at most a block of them
        )
        blocks.write.parquet(f"{folder}-{level}")
        blocks = spark.read.parquet(f"{folder}-{level}")
        level += 1
        largest = -(-largest // shape.block)
        nodes = blocks.select(
            "tree",
            F.col("block").alias("pos"),
            F.expr(f"(total + {shape.block - 1}) DIV {shape.block}").alias("total"),
            _top(shape)(F.col("nodes.hash"), _steps(F.col("total"), shape)).alias("hash"),
            F.struct("block").alias("row"),
        )
        if largest <= 1:
            return level, nodes.select("tree", "hash")


def _placed(leaves: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """(tree, pos, total, hash, row), and the size of the largest tree."""
    spark = leaves.sparkSession
    # equal rows may fill several ranges; which of them stands where makes no difference
    order = ["tree", "key", "hash", "salt"]
    leaves = leaves.withColumn("salt", F.monotonically_increasing_id())
    leaves = leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt", "key")
    # the part in the upper bits, the number of the row in it below
    leaves.withColumn("at", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")  # a row for each part
    earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(of_tree).alias("total"),
    )
    largest = begins.agg(F.max("total")).first()[0] or 0
    placed = rows.join(begins, ["tree", "part"])
    return placed.select("tree", (F.col("at") + F.col("shift")).alias("pos"), "total", "hash", "row"), largest


def _steps(total: Column, shape: Shape) -> Column:
    """How many levels stand between the nodes of a block and the node above: less in a small tree."""
    steps = F.lit(shape.every)
    for k in reversed(range(shape.every)):
        steps = F.when(total <= shape.fanout**k, F.lit(k)).otherwise(steps)
    return steps


def proofs(manifest: Manifest) -> DataFrame:
    """(tree, hash, row, group_root, path) of every leaf.

    ``path`` has the siblings of each level, from the leaf's to the last one below the
    dataset's root: structs of those to the ``left`` and those to the ``right``, joined.
    """
    above = manifest.blocks("groups", manifest.group_levels - 1).select(
        "tree", F.lit(0).cast("long").alias("pos"), F.lit("").alias("group_root"), F.expr(f"cast(array() as {PATH})").alias("path")
    )
    groups = _descend(manifest, "groups", manifest.group_levels, above)
    above = groups.select(
        F.col("row.name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("hash").alias("group_root"), "path"
    )
    return _descend(manifest, "nodes", manifest.levels, above).select("tree", "hash", "row", "group_root", "path")


PATH = "array<struct<left: string, right: string>>"


def _descend(manifest: Manifest, name: str, levels: int, above: DataFrame) -> DataFrame:
    for level in reversed(range(levels)):
        blocks = manifest.blocks(name, level)
        met = blocks.join(above, (blocks["tree"] == above["tree"]) & (blocks["block"] == above["pos"])).select(
            blocks["tree"],
            "group_root",
            "path",
            "nodes",
            _siblings(manifest.shape)(F.col("nodes.hash"), _steps(F.col("total"), manifest.shape)).alias("inner"),
        )
        each = met.select("tree", "group_root", "path", F.explode(F.arrays_zip("nodes", "inner")).alias("x"))
        above = each.select(
            "tree", "x.nodes.pos", "x.nodes.hash", "x.nodes.row", "group_root", F.concat("x.inner", "path").alias("path")
        )
    return above


def _siblings(shape: Shape):
    @F.arrow_udf(f"array<{PATH}>")
    def siblings(hashes: pa.Array, steps: pa.Array) -> pa.Array:
        made = [regenerated(nodes, n, shape.fanout) for nodes, n in zip(hashes.to_pylist(), steps.to_pylist())]
        kind = pa.list_(pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
        return pa.array(made, kind)

    return siblings.asNondeterministic()


def _top(shape: Shape):
    @F.arrow_udf("string")
    def top(hashes: pa.Array, steps: pa.Array) -> pa.Array:
        made = []
        for level, n in zip(hashes.to_pylist(), steps.to_pylist()):
            for _ in range(n):
                level = next_level(level, shape.fanout)
            made.append(level[0])
        return pa.array(made, pa.string())

    return top


def next_level(level: list[str], fanout: int) -> list[str]:
    runs = ("".join(level[i : i + fanout]) for i in range(0, len(level), fanout))
    return [hashlib.sha256(run.encode()).hexdigest() for run in runs]


def regenerated(nodes: list[str], steps: int, fanout: int) -> list[list[tuple[str, str]]]:
    """The siblings of each node on ``steps`` levels, whose interior nodes are made anew."""
    sides, level = [], nodes
    for _ in range(steps):
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        sides.append([("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))])
        level = next_level(level, fanout)
    return [[side[place // fanout**k] for k, side in enumerate(sides)] for place in range(len(nodes))]


def path_hash(path: Column) -> Column:
    """One hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, at: hashed(at["left"], node, at["right"]))

"""What the operators share on a cluster: cut lineage, and components of a graph."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.sources.stores import shared_folder

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors, as ``--py-files`` would, where their path lacks it.

    The archive is made on the driver, sent by Spark itself and removed when the driver ends.
    """
    application = spark.sparkContext.applicationId
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if application in _shipped or str(ROOT) in map(os.path.realpath, filter(None, paths)):
        return
    _shipped.add(application)
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors may fetch the archive until the end
    for module in (ROOT / "lumbung").rglob("*.py"):
        target = Path(folder, "package", module.relative_to(ROOT))
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(module, target)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/lumbung", "zip", f"{folder}/package"))


def shared_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to ``spark.checkpoint.dir``; only where it is unset, below the warehouse."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark, "checkpoints"))


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, in any letter case."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder; a lost executor takes nothing with it."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); the root is the least node of its component.

    Alternating large and small stars: every round hangs the neighbours of a
    node below the least of them, until each component is one star.  No round
    holds the neighbours of a node in one place: minima are aggregated before
    they are shuffled and joined back.
    """
    stars = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                stars.select("b", "b").distinct()
            )
        before = now
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = cut(
            large.join(lower, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lower.select("a", F.col("m").alias("b")))
            .distinct()
        )
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")

"""Tables that lie where their lookups need them.

``BucketedTables`` writes the rows of a table by the hash of a key into a fixed number of
buckets.  Two tables of one key and number are joined bucket by bucket: neither is shuffled,
however often that is done.  One shuffle at the write pays for it, so it suits bridges, which
every conformed table of a run looks up, and events that several reports look up again.

A key with more rows than a mean bucket, and the rows without a key, would make one bucket
the slowest task.  Rows of such hot keys are written beside the buckets as they come.  There are
fewer hot keys than buckets, so their rows of the other side, which has one for each key, are
few enough to broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.lookup import bounded, lookup
from lumbung.sources.paths import put_text, read_text
from lumbung.sources.versions import VersionLog


@dataclass(frozen=True)
class Located:
    """A table's rows: ``rest`` in buckets of ``keys``, ``hot`` beside them, and the keys of ``hot``.

    A ``unique`` table has one row for each key, all of them in its buckets.
    """

    keys: Sequence[str]
    unique: bool
    rest: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    def rows(self) -> DataFrame:
        return self.rest.unionByName(self.hot)


@dataclass(frozen=True)
class BucketedTables:
    """Tables below ``root``; those that are joined have the same number of buckets."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def _log(self, table: str) -> VersionLog:
        return VersionLog(self.spark, f"{self.root.rstrip('/')}/{table}")

    def write(self, table: str, df: DataFrame, keys: Sequence[str], *, unique: bool = False) -> Located:
        """Replace the table; it stays readable while and after a write of it fails.

        ``df`` is read several times, for the keys' counts and for the rows, so it should be a
        written table.  With ``unique`` a key that has several rows is an error.
        """
        log = self._log(table)
        before = log.current()
        parts = {name: log.new_folder() for name in ("rest", "hot", "hot_keys")}
        where = {name: log.folder(folder) for name, folder in parts.items()}
        keyed = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
        counts = df.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        most = df.count() / self.buckets
        hot_counts = counts.where((F.col("__n") > most) & (F.col("__n") > 1))
        if unique:
            repeated = counts.where("__n > 1").first()
            if repeated is not None:
                raise ValueError(f"{table} has {repeated['__n']} rows of one key: {tuple(repeated)[:-1]}")
            hot_counts = hot_counts.limit(0)
        hot_counts.select(*keys).write.parquet(where["hot_keys"])
        hot_keys = bounded(self.spark.read.parquet(where["hot_keys"]))  # fewer than buckets
        rest = df.where(keyed).join(hot_keys, list(keys), "left_anti").select(*df.columns)
        hot = df.where(keyed).join(hot_keys, list(keys), "left_semi").select(*df.columns)
        hot.unionByName(df.where(~keyed)).write.parquet(where["hot"])
        # one file for each bucket: the shuffle hashes as the buckets do
        writer = rest.repartition(self.buckets, *keys).write.format("parquet").option("path", where["rest"])
        writer.bucketBy(self.buckets, *keys).saveAsTable(_catalog_name(where["rest"]))
        layout = {"keys": list(keys), "buckets": self.buckets, "unique": unique}
        put_text(self.spark, f"{where['rest']}/_layout", json.dumps(layout))
        log.commit(parts, before)
        return self.read(table)

    def read(self, table: str) -> Located:
        """The rows of this moment, also in a session that did not write them."""
        log = self._log(table)
        where = {name: log.folder(folder) for name, folder in log.current().parts.items()}
        layout = json.loads(read_text(self.spark, f"{where['rest']}/_layout"))
        if layout["buckets"] != self.buckets:
            raise ValueError(f"{table} has {layout['buckets']} buckets")
        name = _catalog_name(where["rest"])
        if not self.spark.catalog.tableExists(name):
            self._declare(name, where["rest"], layout["keys"])
        hot, hot_keys = (self.spark.read.parquet(where[part]) for part in ("hot", "hot_keys"))
        return Located(layout["keys"], layout["unique"], self.spark.table(name), hot, hot_keys)

    def _declare(self, name: str, folder: str, keys: Sequence[str]) -> None:
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in self.spark.read.parquet(folder).schema
        )
        by = ", ".join(f"`{key}`" for key in keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{folder}'"
        )


def _catalog_name(folder: str) -> str:
    return "lumbung_" + hashlib.md5(folder.encode()).hexdigest()


def colocated_lookup(
    left: Located,
    right: Located,
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """The same as ``lookup`` by the two tables' keys, in their order; ``how`` is left or inner.

    ``right`` is unique on its key.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    if not right.unique:
        raise ValueError("the table that is looked up has to be written as unique")
    on = dict(zip(left.keys, right.keys, strict=True))
    for a, b in on.items():
        if left.rest.schema[a].dataType != right.rest.schema[b].dataType:
            raise ValueError(f"{a} and {b} have different types, and hence different buckets")
    renamed = left.hot_keys.select(*(F.col(a).alias(f"__hot{i}") for i, a in enumerate(on)))
    same = reduce(lambda a, b: a & b, (right.rest[b] == F.col(f"__hot{i}") for i, b in enumerate(on.values())))
    few = bounded(right.rest.join(bounded(renamed), same, "left_semi"))  # a row for each hot key
    return lookup(left.rest, right.rest, on, take, how).unionByName(lookup(left.hot, few, on, take, how))

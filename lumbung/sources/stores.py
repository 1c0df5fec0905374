"""Stores (S6, S7, L1, L4, L5, L8, L10-L12): where tables are written and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumbung.operators.checks import orphan_keys
from lumbung.operators.dedup import dedup_by_key
from lumbung.operators.key_index import (
    BATCH,
    batches_in_range,
    batches_with_keys,
    key_bloom,
    key_hash,
    key_zones,
    word_count,
)
from lumbung.operators.load import audit_columns, new_rows
from lumbung.sources.paths import child_names, delete, delete_at_end, path_exists
from lumbung.sources.readers import conform_schema
from lumbung.sources.shuffles import freed_shuffles
from lumbung.sources.versions import VersionLog

#: the one part of a table that is replaced as a whole
WHOLE = ""


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below one that the cluster shares; it goes when the application ends.

    That is ``spark.checkpoint.dir``, and where it is unset a folder below the
    warehouse, which all executors reach as well.  A result that is read lazily
    still needs its folder, so it is not removed before the end.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lumbung"
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, folder)
    return folder


@dataclass(frozen=True)
class LoadResult:
    """What one load did to one table.  ``n_in`` is None where it was not counted."""

    table: str
    n_in: int | None
    n_new: int

    @property
    def n_skipped(self) -> int | None:
        return None if self.n_in is None else self.n_in - self.n_new


@dataclass(frozen=True)
class KeySummaries:
    """The key summaries of a table's batches or parts (see ``key_index``), below one folder."""

    spark: SparkSession
    folder: str

    def _path(self, kind: str, name: str) -> str:
        return f"{self.folder}/{kind}/{BATCH}={name}"

    def names(self) -> set[str]:
        """What has a whole summary: its zones are written last."""
        root = f"{self.folder}/zones"
        if not path_exists(self.spark, root):
            return set()
        names = [n for n in child_names(self.spark, root) if n.startswith(f"{BATCH}=")]
        return {n.removeprefix(f"{BATCH}=") for n in names if path_exists(self.spark, f"{root}/{n}/_SUCCESS")}

    def add(self, name: str, rows: DataFrame, keys: Sequence[str], n_rows: int | None = None) -> None:
        """``rows`` is a written table; its keys are read twice.  ``n_rows``: their number, where it is known."""
        if n_rows is None:
            n_rows = rows.count()  # from the file footers
        key_bloom(rows, keys, n_rows).write.mode("overwrite").parquet(self._path("bloom", name))
        zones = key_zones(rows, keys).withColumn("words", F.lit(word_count(n_rows)).cast("long"))
        zones.write.mode("overwrite").parquet(self._path("zones", name))

    def forget(self, name: str) -> None:
        for kind in ("zones", "bloom"):
            delete(self.spark, self._path(kind, name))

    def keep(self, names: set[str]) -> None:
        for name in self.names() - names:
            self.forget(name)

    def _read(self, kind: str, names: Sequence[str]) -> DataFrame:
        paths = [self._path(kind, name) for name in names]
        rows = self.spark.read.option("basePath", f"{self.folder}/{kind}").parquet(*paths)
        return rows.withColumn(BATCH, F.col(BATCH).cast("string"))

    def candidates(self, rows: DataFrame, keys: Sequence[str], names: set[str]) -> set[str]:
        """Which of ``names`` may hold a key of ``rows``; what has no summary may.

        The filters are asked only where the batches in range have more rows than ``rows``: to look
        each of its keys up would cost more than to read those batches, which is all that it can save.
        """
        known = sorted(names & self.names())
        if not known:
            return set(names)
        mine = key_zones(rows.select(*keys), keys)
        zones = self._read("zones", known)
        near = {r[0] for r in batches_in_range(zones, mine).collect()}  # at most the batches' names
        if not near:
            return set(names) - set(known)
        # a row for each batch in range
        totals = zones.where(F.col(BATCH).isin(*near)).groupBy(BATCH).agg(F.sum("n"), F.max("words")).collect()
        if sum(n for _, n, _ in totals) > mine.agg(F.sum("n")).first()[0]:
            sizes = sorted({words for _, _, words in totals})
            bloom = self._read("bloom", sorted(near))
            near = {r[0] for r in batches_with_keys(bloom, rows.select(*keys), keys, sizes).collect()}
        return near | (set(names) - set(known))


@dataclass(frozen=True)
class ParquetStore:
    """Tables as Parquet folders below ``root``.

    A batch is one partition of an appended table.  Loading the same batch
    again replaces that partition, so a load that failed half-way can simply be
    repeated.  A table that is replaced as a whole has versions (see
    ``VersionLog``): it stays readable while and after a load of it fails.
    """

    spark: SparkSession
    root: str

    def _folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def versions(self, table: str) -> VersionLog:
        return VersionLog(self.spark, self._folder(table))

    def path(self, table: str) -> str:
        """Where the table's files are now; a replaced table has another folder after each commit."""
        commit = self.versions(table).current()
        if commit is None:
            return self._folder(table)
        if set(commit.parts) != {WHOLE}:
            raise ValueError(f"{table} has several parts")
        return self.versions(table).folder(commit.parts[WHOLE])

    def version(self, table: str) -> str:
        """What names the present rows of a replaced table; empty where there are none."""
        commit = self.versions(table).current()
        return "" if commit is None else ",".join(sorted(commit.parts.values()))

    def exists(self, table: str) -> bool:
        """A folder in which nothing was committed, only begun, is no table."""
        if not path_exists(self.spark, self._folder(table)):
            return False
        if self.versions(table).current() is not None:
            return True
        names = child_names(self.spark, self._folder(table))
        return "_versions" not in names or any(not name.startswith(("_", ".")) for name in names)

    def read(self, table: str) -> DataFrame:
        """The rows of this moment: later commits do not change the frame."""
        return self.spark.read.parquet(self.path(table))

    def read_existing(self, table: str, schema: str, by_month: bool = False) -> DataFrame | None:
        """``None`` only where there is no such table; other errors are raised.

        The schema is declared, so a folder left by a first load that failed
        before it wrote anything reads as an empty table.
        """
        if not self.exists(table):
            return None
        declared = f"{schema}, etl_loaded_at timestamp, etl_batch_id string"
        if by_month:
            declared += ", etl_month string"
        return self.spark.read.schema(declared).parquet(self._folder(table))

    def batch_ids(self, table: str) -> list[str]:
        """The batches an appended table consists of, by the names of its partitions."""
        if not self.exists(table):
            return []
        prefix = "etl_batch_id="
        names = child_names(self.spark, self._folder(table))
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """L1: replace the table, and give back the rows as written.

        The frame read back has a short lineage and file statistics, from which
        the optimizer sees whether it is small enough to broadcast.  ``df`` may
        read the version that it replaces.  What it shuffles goes with the write.
        """
        return self.write_parts(table, [df])

    def write_parts(self, table: str, parts: Iterable[DataFrame]) -> DataFrame:
        """``write`` for rows that come in several frames of one schema, one after another.

        What a part shuffles goes before the next one begins; all become the table with one commit.
        """
        log = self.versions(table)
        before, name = log.current(), log.new_folder()
        for part in parts:
            with freed_shuffles(self.spark):
                _writer(part).mode("append").parquet(log.folder(name))
        log.commit({WHOLE: name}, before)
        return self.spark.read.parquet(log.folder(name))

    def snapshot(self, table: str, df: DataFrame, batch_id: str, schema: str) -> LoadResult:
        """The table is what this batch says."""
        counted = Observation()
        rows = audit_columns(conform_schema(df, schema), batch_id)
        self.write(table, rows.observe(counted, F.count(F.lit(1)).alias("n")))
        n_rows = counted.get["n"]  # counted on the way to the files
        return LoadResult(table, n_rows, n_rows)

    def append_new(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        batch_id: str,
        schema: str,
        *,
        null_safe: bool = False,
        count_input: bool = True,
        month_of: str | None = None,
        key_index: bool = False,
    ) -> LoadResult:
        """Append the rows whose key no earlier batch has loaded.

        With ``key_index`` a summary of the batch's keys is stored beside it, and only those
        earlier batches are read that may hold a key of this one: by their summaries, and
        all that have none.

        ``df`` should be a written table, as in the pipeline: counting it for the
        metrics then reads file footers only.  ``count_input=False`` leaves the
        count out for a frame that would have to be computed again.

        ``month_of`` names a date among ``keys``.  Equal keys then have equal
        months, so a batch is partitioned by month too and only the months of
        the batch are read from the history.  A key that does not contain its
        date may come again under another one; its whole key history is read.
        """
        if month_of is not None and month_of not in keys:
            raise ValueError(f"{month_of} is no part of the key, which may occur in any month")
        incoming = conform_schema(df, schema)
        existing = self.read_existing(table, schema, by_month=month_of is not None)
        if existing is not None:
            existing = existing.where(F.col("etl_batch_id") != batch_id)
            if key_index:
                chosen = self.key_summaries(table).candidates(incoming, keys, set(self.batch_ids(table)) - {batch_id})
                existing = existing.where(F.col("etl_batch_id").isin(*chosen))
        if month_of is not None:
            incoming = incoming.withColumn("etl_month", _month(month_of))
            if existing is not None:
                # as many rows as the calendar has months
                months = [row[0] for row in incoming.select("etl_month").distinct().collect()]
                existing = existing.where(F.col("etl_month").isin(*months))
        fresh = audit_columns(new_rows(incoming, existing, keys, null_safe=null_safe), batch_id)
        # the batch's own folder is replaced even where it gets no row
        counted = Observation()
        fresh = fresh.drop("etl_batch_id").observe(counted, F.count(F.lit(1)).alias("n"))
        if month_of is None:
            writer = _writer(fresh).mode("overwrite")
        else:  # few files a month, and a large month in several
            writer = _writer(fresh.hint("rebalance", "etl_month")).mode("overwrite").partitionBy("etl_month")
        self.key_summaries(table).forget(batch_id)  # of the rows that are replaced now
        writer.parquet(self.batch_path(table, batch_id))
        if key_index:
            own = self.read_existing(table, schema, by_month=month_of is not None)
            batch = own.where(F.col("etl_batch_id") == batch_id)
            self.key_summaries(table).add(batch_id, batch, keys, counted.get["n"])
        return LoadResult(table, df.count() if count_input else None, counted.get["n"])

    def key_summaries(self, table: str) -> KeySummaries:
        return KeySummaries(self.spark, f"{self._folder(table)}/_keys")

    def read_parts(self, table: str) -> DataFrame:
        """The rows of a table kept by ``load_latest``."""
        log = self.versions(table)
        return self.spark.read.parquet(*(log.folder(name) for name in sorted(log.current().parts.values())))

    def load_latest(
        self, table: str, df: DataFrame, keys: Sequence[str], batch_id: str, schema: str, *, count_input: bool = True
    ) -> LoadResult:
        """L5 with updates: the newest row of each key, by the time of its load.

        A part of the table is a batch's rows.  A row whose key is there with other values
        replaces the old one: only the parts that hold such a key are written again, without
        it, and the new row goes to this batch's part.  A row that is there as it is stays in
        its batch.  All changes become the table with one commit, so a failed or repeated load
        leaves no key twice.  Of rows with one key in a batch the least one counts.

        The parts that may hold a key are found by their summaries, as in ``append_new``.
        """
        log = self.versions(table)
        before = log.current()
        parts = dict(before.parts) if before else {}
        summaries = self.key_summaries(table)
        incoming = dedup_by_key(conform_schema(df, schema), keys)
        chosen = sorted(summaries.candidates(incoming, keys, set(parts.values())))
        changed, touched = None, []
        if chosen:
            history = self._parts_with_name(log, chosen)
            own = key_hash(StructType.fromDDL(schema).fieldNames())  # of all values
            old = history.select(*keys, own.alias("__old"), "__part")
            state = incoming.withColumn("__new", own).join(old, list(keys), "left")
            name = log.new_folder()
            # written, since the parts to write again depend on it
            fresh = state.where("__old IS NULL OR __old <> __new")
            fresh.write.parquet(log.folder(name))
            changed = self.spark.read.parquet(log.folder(name))
            touched = [r[0] for r in changed.select("__part").where("__part IS NOT NULL").distinct().collect()]
            incoming = changed.drop("__new", "__old", "__part")
        for part, folder in list(parts.items()):
            if folder in touched:
                gone = changed.where(F.col("__part") == folder).select(*keys)
                rows = self.spark.read.parquet(log.folder(folder)).join(gone, list(keys), "left_anti")
                parts[part] = self._write_part(log, rows, keys, summaries)
        counted = Observation()
        rows = audit_columns(incoming, batch_id).observe(counted, F.count(F.lit(1)).alias("n"))
        folder = log.new_folder()
        rows.write.parquet(log.folder(folder))
        n_new = counted.get["n"]
        if n_new and batch_id in parts:  # a repeated load adds to its own part
            both = self.spark.read.parquet(log.folder(parts[batch_id]), log.folder(folder))
            parts[batch_id] = self._write_part(log, both, keys, summaries)
        elif n_new:
            parts[batch_id] = folder
            summaries.add(folder, self.spark.read.parquet(log.folder(folder)), keys)
        if before is None or parts != dict(before.parts):
            log.commit(parts or {batch_id: folder}, before)
            summaries.keep(set(parts.values()) | set(before.parts.values() if before else ()))
        return LoadResult(table, df.count() if count_input else None, n_new)

    def _parts_with_name(self, log: VersionLog, folders: Sequence[str]) -> DataFrame:
        return reduce(
            DataFrame.unionByName,
            (self.spark.read.parquet(log.folder(f)).withColumn("__part", F.lit(f)) for f in folders),
        )

    def _write_part(self, log: VersionLog, rows: DataFrame, keys: Sequence[str], summaries: KeySummaries) -> str:
        folder = log.new_folder()
        rows.write.parquet(log.folder(folder))
        summaries.add(folder, self.spark.read.parquet(log.folder(folder)), keys)
        return folder

    def repeated_keys(self, table: str, keys: Sequence[str], batch_id: str, schema: str) -> DataFrame:
        """Q16 for one batch of an appended table: its keys that the table has more than once, with their number.

        Earlier batches without a key of the batch, by their summaries, are not read.
        """
        rows = self.read_existing(table, schema)
        batch = rows.where(F.col("etl_batch_id") == batch_id).select(*keys)
        others = set(self.batch_ids(table)) - {batch_id}
        chosen = self.key_summaries(table).candidates(batch, keys, others)
        some = rows.where(F.col("etl_batch_id").isin(batch_id, *chosen)).select(*keys)
        return (
            some.join(batch.distinct(), list(keys), "left_semi")
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where("n_rows > 1")
        )

    def orphan_keys(
        self, table: str, key: str, batch_id: str, schema: str, parent: str, parent_key: str, parent_schema: str
    ) -> DataFrame:
        """Q17 for one batch of an appended table: its foreign keys without a parent row, with their number.

        Batches of the parent that hold none of the keys, by their summaries, are not read.
        """
        kind = StructType.fromDDL(parent_schema)[parent_key].dataType
        rows = self.read_existing(table, schema).where(F.col(BATCH) == batch_id).select(F.col(key).cast(kind))
        parents = self.read_existing(parent, parent_schema)
        wanted = rows.select(F.col(key).alias(parent_key)).dropna().distinct()
        chosen = self.key_summaries(parent).candidates(wanted, [parent_key], set(self.batch_ids(parent)))
        return orphan_keys(rows, key, parents.where(F.col(BATCH).isin(*chosen)), parent_key)

    def batch_path(self, table: str, batch_id: str) -> str:
        return f"{self._folder(table)}/etl_batch_id={batch_id}"


def _writer(df: DataFrame) -> DataFrameWriter:
    """Ids are digits of hashes, as text; of these zstd leaves little more than their bits."""
    return df.write.option("compression", "zstd")


def _month(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


@dataclass(frozen=True)
class JdbcStore:
    """The same tables in a database, over JDBC.

    ``num_partitions`` bounds the number of connections; rows are never brought
    together in one task to be written.  ``partitioning`` names, per table, the
    options by which it is read in parallel.  ``column_types`` are the types of
    tables that Spark has to create (see ``jdbc_column_types``).
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str]
    num_partitions: int = 8
    batch_size: int = 500
    column_types: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def read_options(self, table: str) -> dict[str, str]:
        more = self.partitioning.get(table, {})
        return {"url": self.url, "dbtable": table, **self.properties, **more}

    def write_options(self, table: str, mode: str) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.num_partitions),
            **self.properties,
        }
        if mode == "overwrite":
            options["truncate"] = "true"
        if table in self.column_types:
            options["createTableColumnTypes"] = self.column_types[table]
        return options

    def batch_ids(self, table: str) -> list[str]:
        """The batches the table consists of; the database makes them distinct."""
        if not self.exists(table):
            return []
        rows = self._query(f"SELECT DISTINCT etl_batch_id FROM {table}").collect()
        return sorted(row[0] for row in rows)

    def exists(self, table: str) -> bool:
        """S7, by the standard catalogue; an error of the connection is raised."""
        return not self._query(self.exists_sql(table)).isEmpty()

    def exists_sql(self, table: str) -> str:
        """A table of the connection's own schema; other schemas may have the same name."""
        schema = "DATABASE()" if self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else "CURRENT_SCHEMA"
        return (
            f"SELECT table_name FROM information_schema.tables WHERE table_name = '{table}'"
            f" AND table_schema = {schema}"
        )

    def _query(self, sql: str) -> DataFrame:
        options = {**self.properties, "url": self.url, "query": sql}
        return self.spark.read.format("jdbc").options(**options).load()

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.read_options(table)).load()

    def snapshot(self, table: str, df: DataFrame, batch_id: str, schema: str) -> LoadResult:
        """The old rows are truncated, so the table keeps its definition."""
        self.write(table, audit_columns(conform_schema(df, schema), batch_id), "overwrite")
        n_rows = self.read(table).count()
        return LoadResult(table, n_rows, n_rows)

    def append_new(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        batch_id: str,
        schema: str,
        *,
        null_safe: bool = False,
        count_input: bool = True,
    ) -> LoadResult:
        """L5/L8.  A repeated batch adds what its failed run has not written.

        That goes by the keys, so a batch should not hold one key twice when it
        may have to be repeated; the event ids of the pipeline are unique.
        """
        existing = self.read(table) if self.exists(table) else None
        fresh = new_rows(conform_schema(df, schema), existing, keys, null_safe=null_safe)
        self.write(table, audit_columns(fresh, batch_id), "append")
        n_new = self.read(table).where(F.col("etl_batch_id") == batch_id).count()
        return LoadResult(table, df.count() if count_input else None, n_new)

    def write(self, table: str, df: DataFrame, mode: str) -> None:
        df.write.format("jdbc").options(**self.write_options(table, mode)).mode(mode).save()


def jdbc_column_types(schema: str, text_length: int = 255, long_texts: Sequence[str] = ()) -> str:
    """The ``createTableColumnTypes`` of a declared schema.

    Text gets a length (1000 for ``long_texts``) because databases do not
    index unbounded text; the other types have the same name on both sides.
    """

    def sql_type(name: str, kind: str) -> str:
        if kind == "string":
            return f"VARCHAR({1000 if name in long_texts else text_length})"
        return kind.upper()

    declared = f"{schema}, etl_loaded_at timestamp, etl_batch_id string"
    return ", ".join(
        f"{f.name} {sql_type(f.name, f.dataType.simpleString())}"
        for f in StructType.fromDDL(declared).fields
    )

"""Readers (S1-S5, S8-S10).  Every reader is lazy and has a declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumbung.sources.paths import path_exists


@dataclass(frozen=True)
class SqlDump:
    """Where a table's rows are in a dump of INSERT statements.

    The dump has one value tuple per line; a tuple belongs to the table when
    its first value, the id, starts with ``id_prefix``.
    """

    id_prefix: str


@dataclass(frozen=True)
class TableSource:
    """How to read one table.

    ``format`` is any Spark format name (``csv``, ``json``, ``parquet``,
    ``jdbc``, ``mongodb`` ...) or ``sqldump``.  A JDBC table is read in
    parallel when the options name ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``.  ``optional`` turns a missing path
    into an empty table; any other error is raised.
    """

    name: str
    schema: str
    format: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    dump: SqlDump | None = None
    optional: bool = False


def read_table(spark: SparkSession, source: TableSource) -> DataFrame:
    if source.optional and source.path is not None and not path_exists(spark, source.path):
        return empty_table(spark, source.schema)
    if source.format == "sqldump":
        return read_sql_dump(spark, source.path, source.schema, source.dump)
    reader = spark.read.format(source.format).options(**source.options)
    if source.format == "jdbc":
        # the database declares the types; the cast below makes them ours
        return conform_schema(reader.load(), source.schema)
    if source.format == "csv":
        reader = reader.option("header", True)
    reader = reader.schema(source.schema)
    return reader.load(source.path) if source.path is not None else reader.load()


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, but every declared column, so that later steps still resolve."""
    return spark.createDataFrame([], schema)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few configured rows."""
    return spark.createDataFrame(list(rows), schema)


def conform_schema(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` that ``df`` has."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(
        *(F.col(f.name).cast(f.dataType) for f in declared.fields if f.name in df.columns)
    )


def read_sql_dump(spark: SparkSession, path: str, schema: str, dump: SqlDump) -> DataFrame:
    """Rows of one table out of a text dump of INSERT statements.

    Lines are split over tasks like any text file and parsed by ``from_csv``
    with the quoting rules of SQL: ``'`` quotes, a doubled ``'`` is one quote.
    """
    line = F.trim(F.col("value"))
    values = F.regexp_replace(F.regexp_replace(line, r"^\(", ""), r"\)\s*[,;]?$", "")
    options = {
        "quote": "'",
        "escape": "'",
        "nullValue": "NULL",
        "ignoreLeadingWhiteSpace": "true",
    }
    parsed = F.from_csv(values, schema, options)
    return (
        spark.read.text(path)
        .where(line.startswith(f"('{dump.id_prefix}"))
        .select(parsed.alias("row"))
        .select("row.*")
    )


def csv_to_documents(
    spark: SparkSession, tables: Iterable[TableSource], target: str
) -> list[str]:
    """Seed a document store from CSV files, one folder of JSON lines per table.

    A table whose file is missing is skipped.  Returns the names written.
    """
    written = []
    for table in tables:
        if not path_exists(spark, table.path):
            continue
        rows = read_table(spark, table)
        rows.write.mode("overwrite").json(f"{target}/{table.name}")
        written.append(table.name)
    return written

"""File sources and extract over files that are written from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.load import audit_columns, new_batch_id
from lumbung.plans.pipeline import PipelineConfig, extract
from lumbung.sources.readers import SqlDump, TableSource, csv_to_documents, read_table
from lumbung.sources.stores import shared_folder
from workload.registry import query, table

# texts with a comma, quotes, blanks at either end, nothing, and NULL
NOTE = (
    "CASE {key} % 6 WHEN 0 THEN NULL WHEN 1 THEN 'one, \"two\", three' WHEN 2 THEN '  blanks  '"
    " WHEN 3 THEN 'it''s (here), so' WHEN 4 THEN '' ELSE {text} END"
)
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _extracted(spark: SparkSession, folder: str, source: TableSource) -> DataFrame:
    """The table as ``extract`` has copied it into the work folder."""
    config = PipelineConfig({"given": {source.name: source}}, folder, "B1")
    extract(spark, config, "given")
    return config.work(spark, "given").read(source.name)


ORDERS = "o_orderkey bigint, o_custkey bigint, day date, o_totalprice double, note string"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_orderdate AS date) AS day", "cast(o_totalprice AS double) AS o_totalprice",
        NOTE.replace("''s", "\\'s").format(key="o_orderkey", text="o_orderpriority") + " AS note",
    )


@query(
    "source_csv",
    "SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day, o_totalprice::DOUBLE AS o_totalprice,"
    f" nullif({NOTE.format(key='o_orderkey', text='o_orderpriority')}, '') AS note,"
    " 'BATCH-20240120-030405' AS etl_batch_id FROM orders",
)
def source_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV, extracted, with the id of a batch of a given time.

    CSV has no empty text: it is read as NULL.
    """
    folder = shared_folder(spark, "csv")
    orders = _orders(spark, sf_dir)
    orders.write.options(header=True, **KEEP_BLANKS).csv(f"{folder}/files/orders")
    source = TableSource("orders", ORDERS, "csv", f"{folder}/files/orders")
    batch = new_batch_id(dt.datetime(2024, 1, 20, 3, 4, 5))
    return audit_columns(_extracted(spark, folder, source), batch).drop("etl_loaded_at")


CUSTOMERS = "c_custkey bigint, c_name string, c_nationkey bigint, note string"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "cast(c_nationkey AS bigint) AS c_nationkey",
        NOTE.replace("''s", "\\'s").format(key="c_custkey", text="c_mktsegment") + " AS note",
    )


_CUSTOMERS_SQL = (
    "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey,"
    f" {NOTE.format(key='c_custkey', text='c_mktsegment')} AS note FROM customer"
)
_FROM_CSV_SQL = f"SELECT * REPLACE (nullif(note, '') AS note) FROM ({_CUSTOMERS_SQL})"


@query("source_documents", _CUSTOMERS_SQL)
def source_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: customers as JSON documents, which leave NULL fields out, extracted."""
    folder = shared_folder(spark, "documents")
    _customers(spark, sf_dir).write.json(f"{folder}/files/customer")
    return _extracted(spark, folder, TableSource("customer", CUSTOMERS, "json", f"{folder}/files/customer"))


@query("csv_to_documents", _FROM_CSV_SQL)
def documents_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files turned into documents; a table without a file is skipped."""
    folder = shared_folder(spark, "seed")
    _customers(spark, sf_dir).write.options(header=True, **KEEP_BLANKS).csv(f"{folder}/customer")
    tables = [TableSource(name, CUSTOMERS, "csv", f"{folder}/{name}") for name in ("customer", "not_there")]
    (written,) = csv_to_documents(spark, tables, f"{folder}/documents")
    return read_table(spark, TableSource(written, CUSTOMERS, "json", f"{folder}/documents/{written}"))


LINES = "id string, l_partkey bigint, ship_date date, l_quantity decimal(15,2), note string"


def _literal(column: str, quoted: bool) -> str:
    text = f"replace(cast({column} AS string), \"'\", \"''\")"
    shown = f"concat(\"'\", {text}, \"'\")" if quoted else text
    return f"coalesce({shown}, 'NULL')"


@query(
    "source_sql_dump",
    "SELECT 'LIN-' || l_orderkey || '-' || l_linenumber AS id, l_partkey, l_shipdate::DATE AS ship_date,"
    f" l_quantity::DECIMAL(15,2) AS l_quantity, {NOTE.format(key='l_partkey', text='l_returnflag')} AS note"
    " FROM lineitem",
)
def source_sql_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines out of INSERT statements, between those of another table."""
    folder = shared_folder(spark, "dump")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('LIN-', l_orderkey, '-', l_linenumber) AS id", "l_partkey", "cast(l_shipdate AS date) AS ship_date",
        "cast(l_quantity AS decimal(15,2)) AS l_quantity",
        NOTE.replace("''s", "\\'s").format(key="l_partkey", text="l_returnflag") + " AS note",
    )
    values = [_literal(name, name in ("id", "ship_date", "note")) for name in lines.columns]
    tuples = lines.selectExpr(f"concat('(', concat_ws(',', {', '.join(values)}), '),') AS value")
    others = table(spark, sf_dir, "part").selectExpr("concat(\"('PRT-\", p_partkey, \"','LIN-1'),\") AS value")
    tuples.unionByName(others).write.text(f"{folder}/files/dump.sql")
    source = TableSource("lineitem", LINES, "sqldump", f"{folder}/files/dump.sql", dump=SqlDump("LIN"))
    return _extracted(spark, folder, source)


@query(
    "source_missing",
    "SELECT o_orderkey, NULL::VARCHAR AS reason FROM orders",
)
def source_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was never delivered is empty and has its declared columns."""
    folder = shared_folder(spark, "missing")
    source = TableSource("returns", "r_orderkey bigint, reason string", "csv", f"{folder}/none", optional=True)
    returns = _extracted(spark, folder, source)
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(returns, orders["o_orderkey"] == returns["r_orderkey"], "left").select("o_orderkey", "reason")

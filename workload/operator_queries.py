"""Single operators over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import (
    blank_to_unknown,
    category_of,
    equality_flag,
    first_existing_column,
    global_id,
    literal_tags,
    ordinal_rank,
    pii_hash,
    prefixed_id,
    presence_flag,
    recode,
    rescale,
    safe_date,
    standardize,
    standardize_with_table,
    surrogate_key,
    text_key,
    threshold_label,
    whole_number,
)
from lumbung.operators import (
    at_least,
    date_dimension,
    dedup_by_key,
    distinct_values,
    lookup,
    new_rows,
    not_after,
    pick_per_entity,
    quality_gate,
    reject_report,
    required,
    salted_lookup,
    stack_values,
    union_all,
    value_dimension,
    within,
)
from lumbung.plans.fixed_values import MONTH_NAMES
from lumbung.sources.bucketed import BucketedTables, Located, colocated_lookup
from lumbung.sources.stores import ParquetStore, shared_folder
from workload.registry import query, table
from workload.star_oracles import crc32

# ---- P2-P23: projection and cleaning


@query("drift_column", "SELECT o_orderkey, o_orderdate::DATE AS order_date FROM orders")
def drift_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    name = first_existing_column(orders, ["tanggal_order", "order_date", "o_orderdate"])
    return orders.select("o_orderkey", F.col(name).cast("date").alias("order_date"))


@query(
    "source_tags_and_ids",
    "SELECT 'PLT-C' AS id_platform, 'Customers' AS nama_platform, 'C-' || c_custkey AS event_id,"
    " c_custkey::VARCHAR AS platform_key FROM customer"
    " UNION ALL SELECT 'PLT-S', 'Suppliers',"
    " 'S-' || CASE WHEN s_nationkey <> 3 THEN s_suppkey END, s_suppkey::VARCHAR FROM supplier",
)
def source_tags_and_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        prefixed_id("C-", "c_custkey").alias("event_id"),
        text_key("c_custkey").alias("platform_key"),
    )
    suppliers = table(spark, sf_dir, "supplier")
    native = F.when(F.col("s_nationkey") != 3, F.col("s_suppkey"))
    suppliers = suppliers.select(
        prefixed_id("S-", native).alias("event_id"), text_key("s_suppkey").alias("platform_key")
    )
    return union_all(
        [
            literal_tags(customers, id_platform="PLT-C", nama_platform="Customers"),
            literal_tags(suppliers, id_platform="PLT-S", nama_platform="Suppliers"),
        ]
    )


@query(
    "safe_dates",
    "SELECT o_orderkey, TRY_CAST(CASE o_orderpriority WHEN '5-LOW' THEN 'no date'"
    " WHEN '2-HIGH' THEN '1999-02-30' ELSE o_orderdate::DATE::VARCHAR END AS DATE) AS order_date"
    " FROM orders",
)
def safe_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", "no date")
        .when(F.col("o_orderpriority") == "2-HIGH", "1999-02-30")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", safe_date(text).alias("order_date"))


@query(
    "blank_to_unknown",
    "SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'Tidak Diketahui' WHEN 1 THEN"
    " 'Tidak Diketahui' WHEN 2 THEN 'Tidak Diketahui' WHEN 3 THEN 'Tidak Diketahui'"
    " WHEN 4 THEN ' Bali ' ELSE c_name END AS province, 'Tidak Diketahui' AS no_column"
    " FROM customer",
)
def blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    text = (
        F.when(nation == 0, "")
        .when(nation == 1, "  ")
        .when(nation == 2, F.lit(None))
        .when(nation == 3, " NaN ")
        .when(nation == 4, " Bali ")
        .otherwise(F.col("c_name"))
    )
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey",
        blank_to_unknown(text).alias("province"),
        blank_to_unknown(first_existing_column(customers, ["province"])).alias("no_column"),
    )


@query(
    "unit_rescale",
    "SELECT l_orderkey, l_linenumber, l_partkey,"
    " round(l_quantity / 60, 2)::DECIMAL(10,2) AS minutes_of_seconds,"
    " (l_quantity * 60)::DECIMAL(10,2) AS minutes_of_hours,"
    " (l_quantity / 10)::DECIMAL(5,2) AS score, (l_quantity / 2)::DECIMAL(3,1) AS rating,"
    " trunc(l_quantity / 4)::INTEGER AS whole,"
    " CASE WHEN round(l_extendedprice) < 10000 THEN round(l_extendedprice)::DECIMAL(4,0) END"
    " AS too_big FROM lineitem",
)
def unit_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        rescale(quantity, "decimal(10,2)", divided_by=60).alias("minutes_of_seconds"),
        rescale(quantity, "decimal(10,2)", times=60).alias("minutes_of_hours"),
        rescale(quantity, "decimal(5,2)", divided_by=10).alias("score"),
        rescale(quantity, "decimal(3,1)", divided_by=2).alias("rating"),
        whole_number(quantity / 4).alias("whole"),
        rescale(F.round("l_extendedprice"), "decimal(4,0)").alias("too_big"),
    )


@query(
    "threshold_flags",
    "SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 'lulus' ELSE 'tidak_lulus' END"
    " AS result, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done_flag,"
    " CASE WHEN nullif(o_orderpriority, '5-LOW') IS NOT NULL THEN 1 ELSE 0 END AS has_priority,"
    " CASE WHEN nullif(o_orderstatus, 'O') = 'P' THEN 1 ELSE 0 END AS null_is_zero FROM orders",
)
def threshold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        threshold_label(F.col("o_totalprice"), 250000).alias("result"),
        equality_flag(F.col("o_orderstatus"), "F").alias("done_flag"),
        presence_flag(priority).alias("has_priority"),
        equality_flag(known, "P").alias("null_is_zero"),
    )


@query(
    "category_rank",
    "SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'sized'"
    " WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'cheap' ELSE 'other' END AS category,"
    " CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 ELSE 4 END AS rank,"
    " CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE p_type END AS recoded FROM part",
)
def category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    categories = {"sized": ["SMALL", "MEDIUM", "LARGE"], "cheap": ["PROMO", "ECONOMY"]}
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        category_of(kind, categories, "other").alias("category"),
        ordinal_rank(kind, {"SMALL": 1, "MEDIUM": 2, "LARGE": 3}, 4).alias("rank"),
        recode(kind, {"SMALL": "S", "LARGE": "L"}).alias("recoded"),
    )


# ---- M1-M12: dictionaries


@query(
    "std_null_on_miss",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'kartu'"
    " WHEN '2-HIGH' THEN 'transfer' END AS method FROM orders",
)
def std_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = {"1-URGENT": "kartu", "2-HIGH": "transfer"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", standardize(F.col("o_orderpriority"), entries).alias("method")
    )


@query(
    "std_source_on_miss",
    "SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Ekonomi' WHEN 'SMALL' THEN 'Kecil'"
    " ELSE p_type END AS subject FROM part",
)
def std_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = {"ECONOMY": "Ekonomi", "SMALL": "Kecil"}
    return table(spark, sf_dir, "part").select(
        "p_partkey", standardize(F.col("p_type"), entries, on_miss="source").alias("subject")
    )


@query(
    "std_literal_on_miss",
    "SELECT event_id, CASE event_type WHEN 'purchase' THEN 'berhasil' WHEN 'error' THEN 'gagal'"
    " ELSE 'Unknown' END AS status FROM events",
)
def std_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = {"purchase": "berhasil", "error": "gagal"}
    return table(spark, sf_dir, "events").select(
        "event_id",
        standardize(
            F.col("event_type"), entries, on_miss="literal", default="Unknown"
        ).alias("status"),
    )


@query(
    "std_normalized",
    "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'gedung'"
    " WHEN 'FURNITURE' THEN 'mebel' ELSE 'tidak diketahui' END AS normalized,"
    " 'tidak diketahui' AS exact FROM customer",
)
def std_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = {"building": "gedung", "furniture": "mebel"}
    padded = F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit(" "))
    policy = {"on_miss": "literal", "default": "tidak diketahui"}
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        standardize(padded, entries, normalize=True, **policy).alias("normalized"),
        standardize(padded, entries, **policy).alias("exact"),
    )


@query(
    "std_broadcast",
    "SELECT c_custkey, coalesce(n_name, 'elsewhere') AS nation FROM customer"
    " LEFT JOIN nation ON CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END = n_nationkey",
)
def std_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.expr("CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END")  # no such nation
    return standardize_with_table(
        table(spark, sf_dir, "customer").select("c_custkey", own.alias("nationkey")),
        "nationkey",
        table(spark, sf_dir, "nation"),
        key="n_nationkey",
        label="n_name",
        into="nation",
        on_miss="literal",
        default="elsewhere",
    ).select("c_custkey", "nation")


# ---- P12-P17, Q9: gates

AS_OF = dt.date(2000, 6, 30)
PRICE = "CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_extendedprice END"


def _measured_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        "l_quantity",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.expr(PRICE).alias("price"),
    )


def _line_rules():
    return [
        not_after("ship_date", AS_OF),
        within("l_quantity", 5, 45),
        at_least("price", 2000),
        required("price"),
    ]


@query(
    "quality_gate",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity,"
    f" l_shipdate::DATE AS ship_date, {PRICE} AS price FROM lineitem"
    " WHERE l_shipdate::DATE <= DATE '2000-06-30' AND l_quantity BETWEEN 5 AND 45"
    f" AND {PRICE} >= 2000",
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gate(_measured_lines(spark, sf_dir), _line_rules())


@query(
    "reject_report",
    "SELECT l_returnflag, reject_reason, count(*) AS n_rows FROM (SELECT l_returnflag,"
    " CASE WHEN (l_shipdate::DATE <= DATE '2000-06-30') IS NOT TRUE"
    " THEN 'ship_date is missing or in the future'"
    " WHEN (l_quantity BETWEEN 5 AND 45) IS NOT TRUE THEN 'l_quantity is out of range'"
    f" WHEN ({PRICE} >= 2000) IS NOT TRUE THEN 'price is out of range' END AS reject_reason"
    " FROM lineitem) WHERE reject_reason IS NOT NULL GROUP BY ALL",
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_report(_measured_lines(spark, sf_dir), _line_rules(), ["l_returnflag"])


@query(
    "required_and_excluded",
    "SELECT l_returnflag AS flag, l_linestatus AS state, count(*) AS n_rows FROM lineitem"
    " WHERE l_returnflag IN ('A', 'N') AND lower(l_linestatus) <> 'o' GROUP BY ALL",
)
def required_and_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in a set, and exclusion whatever the case."""
    lines = table(spark, sf_dir, "lineitem")
    kept = lines.where(F.col("l_returnflag").isin("A", "N") & (F.lower("l_linestatus") != "o"))
    return kept.groupBy(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("state")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- U1-U3: set operations


@query(
    "conform_union",
    "SELECT 'O-' || o_orderkey AS id, 'orders' AS source, o_orderdate::DATE AS day,"
    " floor(o_totalprice)::DECIMAL(15,2) AS amount FROM orders"
    " UNION ALL SELECT 'L-' || l_orderkey || '-' || l_linenumber, 'lines', l_shipdate::DATE,"
    " floor(l_extendedprice)::DECIMAL(15,2) FROM lineitem"
    " UNION ALL SELECT 'E-' || event_id, 'events', ts::DATE, floor(value)::DECIMAL(15,2)"
    " FROM events",
)
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def conformed(name, prefix, id_, day, amount, source):
        rows = table(spark, sf_dir, name).select(
            prefixed_id(prefix, id_).alias("id"),
            safe_date(day).alias("day"),
            rescale(F.floor(amount), "decimal(15,2)").alias("amount"),
        )
        return literal_tags(rows, source=source)

    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return union_all(
        [
            conformed("orders", "O-", "o_orderkey", "o_orderdate", "o_totalprice", "orders"),
            conformed("lineitem", "L-", line, "l_shipdate", "l_extendedprice", "lines"),
            conformed("events", "E-", "event_id", "ts", "value", "events"),
        ]
    )


def _dated(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, str]]:
    def days(name: str, column: str) -> tuple[DataFrame, str]:
        return table(spark, sf_dir, name).select(F.col(column).cast("date").alias("day")), "day"

    return [days("orders", "o_orderdate"), days("lineitem", "l_shipdate"), days("events", "ts")]


@query(
    "stacked_values",
    "SELECT day, count(*) AS n_rows FROM (SELECT o_orderdate::DATE AS day FROM orders UNION ALL"
    " SELECT l_shipdate::DATE FROM lineitem UNION ALL SELECT ts::DATE FROM events) GROUP BY day",
)
def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack_values(_dated(spark, sf_dir), "day").groupBy("day").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "union_distinct_values",
    "SELECT o_orderdate::DATE AS day FROM orders UNION SELECT l_shipdate::DATE FROM lineitem"
    " UNION SELECT ts::DATE FROM events",
)
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_dated(spark, sf_dir), "day")


# ---- I1-I5: identity

ACCOUNTS = (
    "SELECT 'customers' AS source, c_custkey AS id, 'P' || c_custkey || '@Mail.Id' AS email"
    " FROM customer UNION ALL SELECT 'suppliers', s_suppkey,"
    " CASE WHEN s_nationkey <> 5 THEN 'p' || s_suppkey || '@mail.id' END FROM supplier"
    " UNION ALL SELECT 'events', user_id, 'p' || user_id || '@mail.id' FROM events GROUP BY user_id"
)


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mail(prefix: str, id_: str, domain: str):
        return F.concat(F.lit(prefix), F.col(id_).cast("string"), F.lit(domain))

    customers = table(spark, sf_dir, "customer").select(
        F.lit("customers").alias("source"),
        F.col("c_custkey").alias("id"),
        mail("P", "c_custkey", "@Mail.Id").alias("email"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("suppliers").alias("source"),
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_nationkey") != 5, mail("p", "s_suppkey", "@mail.id")).alias("email"),
    )
    users = table(spark, sf_dir, "events").select("user_id").distinct().select(
        F.lit("events").alias("source"),
        F.col("user_id").alias("id"),
        mail("p", "user_id", "@mail.id").alias("email"),
    )
    return union_all([customers, suppliers, users])


@query(
    "user_bridge",
    "SELECT 'USR-' || upper(md5(h)) AS global_id, source, id, h AS email_hash"
    f" FROM (SELECT *, md5(lower(email)) AS h FROM ({ACCOUNTS})) WHERE h IS NOT NULL",
)
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = _accounts(spark, sf_dir).withColumn("email_hash", pii_hash("email"))
    return hashed.where(F.col("email_hash").isNotNull()).select(
        global_id("USR-", F.col("email_hash")).alias("global_id"), "source", "id", "email_hash"
    )


@query(
    "shared_identities",
    "SELECT 'USR-' || upper(md5(md5(lower(email)))) AS global_id,"
    f" count(*) AS n_accounts FROM ({ACCOUNTS}) WHERE email IS NOT NULL"
    " GROUP BY 1 HAVING count(*) > 1",
)
def shared_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People with an account on more than one source."""
    return (
        users(spark, sf_dir)
        .groupBy("global_id")
        .agg(F.count(F.lit(1)).alias("n_accounts"))
        .where("n_accounts > 1")
    )


COURSE = (
    "SELECT p_partkey, concat_ws(' - ', p_type, concat_ws(' ', p_brand, CASE WHEN p_size < 25"
    " THEN 'small' END)) AS name FROM part"
)


@query(
    "course_bridge",
    f"SELECT 'KLS-' || upper(md5(name)) AS global_id, p_partkey, name FROM ({COURSE})",
)
def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = F.when(F.col("p_size") < 25, "small")
    name = F.concat_ws(" - ", "p_type", F.concat_ws(" ", "p_brand", small))
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", name.alias("name"))
        .withColumn("global_id", global_id("KLS-", F.col("name")))
    )


@query(
    "surrogate_md5_60",
    "SELECT c_custkey, ('0x' || substr(md5(c_name), 1, 15))::BIGINT AS key FROM customer",
)
def md5_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", surrogate_key(F.col("c_name"), "md5_60").alias("key")
    )


@query("surrogate_crc32", f"SELECT c_custkey, {crc32('c_name')} AS key FROM customer")
def crc_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", surrogate_key(F.col("c_name"), "crc32").alias("key")
    )


# ---- J1-J14: lookups


def _bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("platform"),
        F.col("s_suppkey").cast("string").alias("platform_id"),
        global_id("USR-", F.col("s_name")).alias("global_id"),
    )


def _lines_of_suppliers(spark: SparkSession, sf_dir: str, supplier: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    nations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.concat(F.lit("N"), F.col("s_nationkey")).alias("platform")
    )
    lines = lines.withColumn("who", F.expr(supplier))
    return lookup(lines, nations, {"who": "k"}, ["platform"]).select(
        "l_orderkey", "l_quantity", "platform", text_key("who").alias("platform_id")
    )


_ENRICHED = (
    "SELECT {id} AS global_id, count(*) AS n_rows, sum(l_quantity)::BIGINT AS quantity FROM"
    " (SELECT *, {who} AS who FROM lineitem) {how} JOIN (SELECT s_suppkey, 'USR-' ||"
    " upper(md5(s_name)) AS gid FROM supplier)"
    " ON who = s_suppkey GROUP BY 1"
)
# a supplier that does not exist, for every eleventh part
MISSING = "CASE WHEN l_partkey % 11 = 0 THEN -1 ELSE l_suppkey END"
HOT = "CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_returnflag = 'A' THEN NULL ELSE l_suppkey END"


def _per_global_id(rows: DataFrame) -> DataFrame:
    return rows.groupBy("global_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query("bridge_enrich", _ENRICHED.format(id="gid", who=MISSING, how=""))
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_of_suppliers(spark, sf_dir, MISSING)
    on = {"platform": "platform", "platform_id": "platform_id"}
    return _per_global_id(lookup(rows, _bridge(spark, sf_dir), on, ["global_id"], "inner"))


@query("bridge_enrich_left", _ENRICHED.format(id="gid", who=MISSING, how="LEFT"))
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_of_suppliers(spark, sf_dir, MISSING)
    on = {"platform": "platform", "platform_id": "platform_id"}
    return _per_global_id(lookup(rows, _bridge(spark, sf_dir), on, ["global_id"]))


@query("bridge_enrich_salted", _ENRICHED.format(id="gid", who=HOT, how="LEFT"))
def enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has one key and a third has none."""
    rows = _lines_of_suppliers(spark, sf_dir, HOT)
    on = {"platform": "platform", "platform_id": "platform_id"}
    return _per_global_id(salted_lookup(rows, _bridge(spark, sf_dir), on, ["global_id"]))


def _located(spark: SparkSession, sf_dir: str, supplier: str) -> tuple[Located, Located]:
    tables = BucketedTables(spark, shared_folder(spark, "located"), buckets=8)
    keys = ["platform", "platform_id"]
    store = ParquetStore(spark, shared_folder(spark, "lines"))
    lines = store.write("lines", _lines_of_suppliers(spark, sf_dir, supplier))
    return tables.write("lines", lines, keys), tables.write("bridge", _bridge(spark, sf_dir), keys, unique=True)


@query("bridge_enrich_located", _ENRICHED.format(id="gid", who=MISSING, how=""))
def enrich_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 without a shuffle: both sides lie in buckets of the key."""
    return _per_global_id(colocated_lookup(*_located(spark, sf_dir, MISSING), ["global_id"], "inner"))


@query("bridge_enrich_located_hot", _ENRICHED.format(id="gid", who=HOT, how="LEFT"))
def enrich_located_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has one key and a third has none: they lie beside the buckets."""
    return _per_global_id(colocated_lookup(*_located(spark, sf_dir, HOT), ["global_id"]))


# ---- A1-A4: deduplication

_LEAST = (
    "SELECT {shown} FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys}"
    " ORDER BY {order}) = 1"
)


@query(
    "dedup_pk",
    _LEAST.format(
        shown="l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag",
        table="lineitem",
        keys="l_orderkey, l_linenumber",
        order="l_partkey, l_suppkey, l_quantity, l_returnflag",
    ),
)
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    return dedup_by_key(lines, ["l_orderkey", "l_linenumber"])


@query(
    "entity_first",
    _LEAST.format(
        shown="o_custkey, o_orderstatus AS status, o_orderpriority AS priority",
        table="orders",
        keys="o_custkey",
        order="o_orderdate, o_orderkey",
    ),
)
def entity_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status and priority of each customer's first order."""
    orders = table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderstatus": "status", "o_orderpriority": "priority"}
    )
    return pick_per_entity(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["status", "priority"]
    )


# ---- D1-D9 on the given tables


@query(
    "date_dim",
    "SELECT ('0x' || substr(md5(day::VARCHAR), 1, 15))::BIGINT AS waktu_key, day AS tanggal,"
    " month(day)::INTEGER AS bulan,"
    f" list_extract({list(MONTH_NAMES.values())}, month(day)) AS nama_bulan,"
    " 'Q' || quarter(day) AS kuartal, year(day)::INTEGER AS tahun FROM ("
    "SELECT o_orderdate::DATE AS day FROM orders UNION SELECT l_shipdate::DATE FROM lineitem"
    " UNION SELECT ts::DATE FROM events)",
)
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(_dated(spark, sf_dir), MONTH_NAMES, "md5_60")


@query(
    "snowflake_dim",
    "SELECT ('0x' || substr(md5(c_custkey::VARCHAR), 1, 15))::BIGINT AS customer_key, c_name,"
    " n_name AS nation, r_name AS region FROM customer"
    " LEFT JOIN nation ON CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE c_nationkey END = n_nationkey"
    " LEFT JOIN region ON n_regionkey = r_regionkey",
)
def snowflake_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that refers to a dimension that refers to another one."""
    own = F.expr("CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE c_nationkey END")  # no such nation
    rows = lookup(
        table(spark, sf_dir, "customer").withColumn("own_nation", own),
        table(spark, sf_dir, "nation"),
        {"own_nation": "n_nationkey"},
        {"n_name": "nation", "n_regionkey": "region_id"},
    )
    rows = lookup(
        rows, table(spark, sf_dir, "region"), {"region_id": "r_regionkey"}, {"r_name": "region"}
    )
    key = surrogate_key(F.col("c_custkey"), "md5_60").alias("customer_key")
    return rows.select(key, "c_name", "nation", "region")


@query(
    "value_dims",
    "SELECT ('0x' || substr(md5(code), 1, 15))::BIGINT AS code_key, code,"
    " CASE code WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 4 END AS rank FROM ("
    "SELECT l_returnflag AS code FROM lineitem UNION SELECT o_orderstatus FROM orders"
    " UNION SELECT l_linestatus FROM lineitem) WHERE lower(code) <> 'f'",
)
def value_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return value_dimension(
        [(lines, "l_returnflag"), (orders, "o_orderstatus"), (lines, "l_linestatus")],
        "code",
        "code_key",
        {"rank": ordinal_rank(F.col("code"), {"A": 1, "N": 2}, 4)},
        keep=F.lower("code") != "f",
        key_kind="md5_60",
    )


# ---- L1-L12: loads


@query(
    "append_new_single",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= DATE '1998-01-01'",
)
def append_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two overlapping batches brings only its new rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    loaded = orders.where("o_orderdate < '1998-01-01'")
    incoming = orders.where("o_orderdate >= '1996-06-01'")
    return new_rows(incoming, loaded, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


_KEYED = (
    "SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey END AS supp,"
    " l_linenumber AS line, l_linestatus AS state, l_quantity FROM lineitem"
)


@query(
    "append_new_nullsafe",
    f"SELECT i.* FROM (SELECT * FROM ({_KEYED}) WHERE state = 'O') i ANTI JOIN"
    f" (SELECT * FROM ({_KEYED}) WHERE state = 'F') e ON i.l_orderkey IS NOT DISTINCT FROM"
    " e.l_orderkey AND i.supp IS NOT DISTINCT FROM e.supp",
)
def append_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL key parts are equal; equal keys inside the batch all stay."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("supp"),
        F.col("l_linenumber").alias("line"),
        F.col("l_linestatus").alias("state"),
        "l_quantity",
    )
    loaded, incoming = rows.where("state = 'F'"), rows.where("state = 'O'")
    return new_rows(incoming, loaded, ["l_orderkey", "supp"], null_safe=True)


ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"


def _load_orders(store: ParquetStore, orders: DataFrame, batch: str):
    return store.append_new("orders", orders, ["o_orderkey"], batch, ORDER_SCHEMA)


@query(
    "append_rerun",
    "SELECT 'B1' AS etl_batch_id, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'"
    " UNION ALL SELECT 'B2', count(*) FROM orders WHERE o_orderstatus <> 'F'",
)
def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is loaded, then everything, then the last batch once more."""
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(spark, shared_folder(spark, "append"))
    _load_orders(store, orders.where("o_orderstatus = 'F'"), "B1")
    _load_orders(store, orders, "B2")
    _load_orders(store, orders, "B2")
    _load_orders(store, orders, "B3")
    return store.read("orders").groupBy("etl_batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "empty_repeat",
    "SELECT 'orders' AS table_name, 0 AS n_in, 0 AS n_new, 0 AS n_skipped,"
    " count(*) FILTER (o_orderstatus = 'F') AS n_rows FROM orders",
)
def empty_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is repeated without any row leaves none of its rows."""
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(spark, shared_folder(spark, "empty"))
    _load_orders(store, orders.where("o_orderstatus = 'F'"), "B1")
    _load_orders(store, orders, "B2")
    result = _load_orders(store, orders.where("false"), "B2")
    return store.read("orders").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(result.table).alias("table_name"),
        F.lit(result.n_in).alias("n_in"),
        F.lit(result.n_new).alias("n_new"),
        F.lit(result.n_skipped).alias("n_skipped"),
        "n_rows",
    )


_DATED_LINES = "l_orderkey bigint, l_linenumber int, ship_date date, l_quantity double"


@query(
    "append_by_month",
    "SELECT l_orderkey, l_linenumber::INTEGER AS l_linenumber, l_shipdate::DATE AS ship_date,"
    " l_quantity::DOUBLE AS l_quantity, strftime(l_shipdate::DATE, '%Y-%m') AS etl_month,"
    " CASE WHEN l_returnflag <> 'N' THEN 'B1' ELSE 'B2' END AS etl_batch_id FROM lineitem x"
    " WHERE l_returnflag <> 'N' OR NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_returnflag <> 'N'"
    " AND y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber"
    " AND y.l_shipdate::DATE = x.l_shipdate::DATE)",
)
def append_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key has the date, so a batch is compared with the history of its own months only."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_shipdate AS date) AS ship_date", "l_quantity", "l_returnflag"
    )
    store = ParquetStore(spark, shared_folder(spark, "months"))
    keys = ["l_orderkey", "l_linenumber", "ship_date"]
    for batch, rows in (("B1", lines.where("l_returnflag <> 'N'")), ("B2", lines)):
        store.append_new("lines", rows, keys, batch, _DATED_LINES, month_of="ship_date")
    return store.read("lines").drop("etl_loaded_at")


@query("batch_split", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def batch_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping batches end in the same table as one."""
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(spark, shared_folder(spark, "split"))
    parts = ["o_orderstatus = 'F'", "o_orderstatus <> 'P'", "o_orderstatus <> 'F'"]
    for number, part in enumerate(parts):
        _load_orders(store, orders.where(part), f"B{number}")
    return store.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "snapshot_load",
    "SELECT c_custkey, c_name, c_nationkey, 'B2' AS etl_batch_id, true AS has_time FROM customer",
)
def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second snapshot replaces the first."""
    customers = table(spark, sf_dir, "customer")
    store = ParquetStore(spark, shared_folder(spark, "snapshot"))
    schema = "c_custkey bigint, c_name string, c_nationkey int"
    store.snapshot("customer", customers.where("c_nationkey < 5"), "B1", schema)
    store.snapshot("customer", customers, "B2", schema)
    return store.read("customer").withColumn(
        "has_time", F.col("etl_loaded_at").isNotNull()
    ).drop("etl_loaded_at")


@query(
    "load_metrics",
    "SELECT 'orders' AS table_name, count(*) AS n_in,"
    " count(*) FILTER (o_orderstatus <> 'F') AS n_new,"
    " count(*) FILTER (o_orderstatus = 'F') AS n_skipped FROM orders",
)
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(spark, shared_folder(spark, "metrics"))
    _load_orders(store, orders.where("o_orderstatus = 'F'"), "B1")
    result = _load_orders(store, orders, "B2")
    return spark.createDataFrame(
        [(result.table, result.n_in, result.n_new, result.n_skipped)],
        "table_name string, n_in bigint, n_new bigint, n_skipped bigint",
    )


# ---- loads that read and rewrite only what a batch touches


def _quarters(orders: DataFrame) -> dict[str, DataFrame]:
    """The orders by key range, as a source delivers them over time; the last batch is late rows of all ranges."""
    late = F.col("o_orderkey") % 7 == 0
    ordinary = {f"B{n}": orders.where(~late & (F.floor(F.col("o_orderkey") / 1000) % 4 == n)) for n in range(4)}
    return {**ordinary, "B4": orders}


@query("append_indexed", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def append_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 with key summaries: five batches, of which the last has all rows again, and one without a summary."""
    store = ParquetStore(spark, shared_folder(spark, "indexed"))
    for batch, rows in _quarters(table(spark, sf_dir, "orders")).items():
        store.append_new("orders", rows, ["o_orderkey"], batch, ORDER_SCHEMA, key_index=batch != "B2")
    return store.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "append_latest",
    "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'B2'"
    " WHEN o_orderstatus = 'F' THEN 'B1' ELSE 'B2' END AS etl_batch_id FROM orders",
)
def append_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 with updates: some orders are open in the first batch and closed in the second one."""
    orders = table(spark, sf_dir, "orders")
    state = F.when(F.col("o_orderkey") % 7 == 0, F.lit("?")).otherwise(F.col("o_orderstatus"))
    store = ParquetStore(spark, shared_folder(spark, "latest"))
    first = orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", state)
    store.load_latest("orders", first, ["o_orderkey"], "B1", ORDER_SCHEMA)
    store.load_latest("orders", orders, ["o_orderkey"], "B2", ORDER_SCHEMA)
    return store.read_parts("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "etl_batch_id")


@query(
    "repeated_keys_of_batch",
    "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IN"
    " (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY ALL HAVING count(*) > 1",
)
def repeated_keys_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16 for a new batch: its customers with several orders, read from the batches that may hold them."""
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(spark, shared_folder(spark, "repeated"))
    for batch, test in (("B1", "o_orderstatus = 'F'"), ("B2", "o_orderstatus <> 'F'")):
        store.append_new("orders", orders.where(test), ["o_orderkey"], batch, ORDER_SCHEMA)
        own = store.read_existing("orders", ORDER_SCHEMA).where(F.col("etl_batch_id") == batch)
        store.key_summaries("orders").add(batch, own, ["o_custkey"])
    return store.repeated_keys("orders", ["o_custkey"], "B2", ORDER_SCHEMA)


@query(
    "orphans_of_batches",
    "SELECT o_orderstatus AS batch, o_custkey, count(*) AS n_rows FROM orders"
    " WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL",
)
def orphans_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17 batch by batch: each one's keys against the parent batches that may hold them."""
    store = ParquetStore(spark, shared_folder(spark, "orphans"))
    suppliers, orders = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    parent = "s_suppkey bigint, s_name string"
    for k in range(3):
        some = suppliers.where(F.floor(F.col("s_suppkey") / 20) % 3 == k)
        store.append_new("supplier", some, ["s_suppkey"], f"S{k}", parent, key_index=k != 1)
    found = []
    for status in ("F", "O", "P"):
        own = orders.where(F.col("o_orderstatus") == status)
        store.append_new("orders", own, ["o_orderkey"], status, ORDER_SCHEMA, count_input=False)
        orphans = store.orphan_keys("orders", "o_custkey", status, ORDER_SCHEMA, "supplier", "s_suppkey", parent)
        found.append(orphans.withColumn("batch", F.lit(status)))
    return union_all(found)


@query("snapshot_after_failure", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 5")
def snapshot_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails after some of its files are written leaves the table as it was."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    store, schema = ParquetStore(spark, shared_folder(spark, "failing")), "c_custkey bigint, c_name string"
    store.snapshot("customer", customers.where("c_nationkey < 5"), "B1", schema)
    failing = customers.withColumn(
        "c_name", F.when(F.col("c_custkey") == 1, F.raise_error(F.lit("planned")).cast("string")).otherwise(F.col("c_name"))
    )
    try:
        store.snapshot("customer", failing, "B2", schema)
    except Exception as error:
        if "planned" not in str(error):
            raise
    return store.read("customer").select("c_custkey", "c_name")

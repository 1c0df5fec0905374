"""The registered queries of this package: each applies one operator to a whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.alignment import align_documents
from lumbung.llm.cluster import ship_package
from lumbung.llm.labelled import held_out_fold, learning_fold
from lumbung.llm.language import fit_language_model, predict_language
from lumbung.llm.licences import scanned
from lumbung.llm.merkle import folded, group_name, leaf_hash, lower_cased, path_hash, proofs, write_manifest
from lumbung.llm.mixing import WORD, mixed
from lumbung.llm.neighbours import nearest
from lumbung.llm.packing import bins_of, packed
from lumbung.llm.quality_model import fit_quality_model, quality_score
from lumbung.llm.rules import judged, learn_rules
from lumbung.llm.shards import materialise
from lumbung.llm.simhash import as_hex, near_duplicates
from lumbung.llm.toxicity import fit_toxicity_model, toxicity_score
from lumbung.llm.urls import ALLOW, BLOCK, Entry, filter_urls
from lumbung.sources.stores import shared_folder

#: permitted sequence lengths of the packing queries, in words
LENGTHS = (512, 1024, 2048, 4096)
#: the entries of the URL query
ENTRIES = (
    Entry(BLOCK, "net", "/"),
    Entry(ALLOW, "example.net", "/en/"),
    Entry(BLOCK, "example.com", "/de/"),
    Entry(ALLOW, "org", "/fr/"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return packed(docs.select("doc_id", size.alias("size")), bins_of(LENGTHS))


@query("op2_projected_neighbours")
def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


MIXING_SQL = """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS at
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), limits AS (
    SELECT *, 3 * source_size AS most, 1 + (place - 1) % 3 AS weight, (3 * source_size)::DOUBLE / (1 + (place - 1) % 3) AS ratio
    FROM sources
), levels AS (
    SELECT *,
        (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM limits
    WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, place,
        least(most::DOUBLE, weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, place LIMIT 1)) AS target
    FROM levels
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.place, t.target, round(t.target)::BIGINT AS budget,
        (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.at, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), parts AS (
    SELECT *, greatest(0, least(size, budget - start)) AS a,
        greatest(0, least(size, budget - start - source_size)) AS b,
        greatest(0, least(size, budget - start - 2 * source_size)) AS c
    FROM placed
), shares AS (
    SELECT *, CASE WHEN a > 0 THEN least((start + a::DOUBLE / 2) / budget, 1.0::DOUBLE) END AS u FROM parts
)
SELECT doc_id, size, source_size, target, (a + b + c)::BIGINT AS taken,
    CASE place % 3 WHEN 1 THEN 2.0::DOUBLE * u / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0::DOUBLE * u))
        WHEN 2 THEN 2.0::DOUBLE * u / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 0.0::DOUBLE * u))
        ELSE 2.0::DOUBLE * u / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * u)) END AS position
FROM shares
"""


@query("op3_curriculum_mix", MIXING_SQL)
def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed(table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position")
    ).orderBy("position", "doc_id")


@query("op4_language_crf")
def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(learning_fold("doc_id", 4, 2)))
    return docs.select(
        "doc_id", held_out_fold("doc_id", 4, 2).alias("held_out"), predict_language(spark, model).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@query("op5_quality_nbsvm")
def op5_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality_model(docs, labels.where(learning_fold("doc_id", 5, 0)))
    return docs.select(
        "doc_id", held_out_fold("doc_id", 5, 0).alias("held_out"), quality_score(spark, model).alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query("op6_decision_list")
def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return judged(docs, rules, "found").select("doc_id", *(f"found.{name}" for name in base))


@query("op7_training_shards")
def op7_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(table(spark, sf_dir, "documents"), shared_folder(spark, "shards"), key=20_240_117)


@query("op8_licence_scan")
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return docs.select("doc_id", scanned(spark).alias("found")).select("doc_id", *(f"found.{name}" for name in names))


@query("op9_simhash_bytes")
def op9_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")


URLS_SQL = """
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), judged AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query("op10_url_trie", URLS_SQL)
def op10_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = filter_urls(spark, pages, list(ENTRIES))
    return found.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


@query("op12_toxicity_distance")
def op12_toxicity_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity_model(docs, labels.where(learning_fold("doc_id", 4, 2)))
    return docs.select(
        "doc_id", held_out_fold("doc_id", 4, 2).alias("held_out"), toxicity_score(spark, model).alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query("op13_merkle_manifest")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is tampered with; their folded roots miss the dataset's root."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "manifest")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    leaves = docs.select(
        group_name(F.col("lang")).alias("tree"),
        F.col("doc_id").alias("key"),
        leaf_hash(fields).alias("hash"),
        F.struct(
            "doc_id", F.when(tampered, leaf_hash([*fields[:-1], lower_cased(F.col("text"))])).alias("tampered")
        ).alias("row"),
    )
    leaves.write.parquet(f"{folder}/leaves")
    manifest = write_manifest(spark.read.parquet(f"{folder}/leaves"), folder)
    return proofs(manifest).select(
        "row.doc_id",
        F.col("hash").alias("leaf"),
        F.col("group_root").alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        path_hash(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("row.tampered", "hash"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op11_fragment_alignment")
def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(spark, table(spark, sf_dir, "documents"), shared_folder(spark, "alignment"))

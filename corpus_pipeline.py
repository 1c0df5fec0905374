"""From raw documents to packed training sequences, in stages that each call one operator.

Every stage works on all rows that its predecessor kept, and all but the last
return the columns of ``documents``.  ``run`` writes each stage's rows as Parquet
below the shared folder and reads them back for the next one, so a lost executor
costs the running stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.cluster import ship_package, unused_name
from lumbung.llm.labelled import learning_fold
from lumbung.llm.language import UNDETERMINED, fit_language_model, predict_language
from lumbung.llm.mixing import WORD, mixed_documents
from lumbung.llm.packing import bins_of, packed
from lumbung.llm.queries import LENGTHS
from lumbung.llm.rules import learn_rules, passing
from lumbung.llm.simhash import one_of_each
from lumbung.sources.stores import shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose words look like those of no learned language, go.

    Without any labelled row there is no model, and documents with a letter stay.
    """
    ship_package(spark)
    model = fit_language_model(docs.where(learning_fold("doc_id", 4, 2)))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    name = unused_name(docs, "language_found")
    found = docs.withColumn(name, predict_language(spark, model, known=True))
    kept = (F.col(f"{name}.lang_pred") != UNDETERMINED) & F.col(f"{name}.known")
    return found.where(kept).drop(name)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or fit a learned rule go."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return passing(docs, learn_rules(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    ship_package(spark)
    return one_of_each(docs, shingle=3, distance=3)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stays as often as the mix takes it."""
    return mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence."""
    ship_package(spark)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return packed(docs.select("doc_id", size.alias("size")), bins_of(LENGTHS))


STAGES = [
    ("language ID", known_language),
    ("quality rules", good_quality),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: models and components have no SQL; the tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

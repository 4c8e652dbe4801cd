"""A training corpus from ``documents``: toxicity, near duplicates, private data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of documents.
Between stages the rows are written as Parquet in the shared checkpoint folder and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia.llm import mixing, packing, pii, simhash, toxicity
from municipia.llm.common import free_name, read
from municipia.session import ensure_checkpoint_dir

REJECTED = toxicity.TOXIC


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is REJECTED or more go. The model learns from the labelled rows of ``documents``."""
    model = toxicity.train_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return toxicity.with_score(docs, model, out=score).filter(F.col(score) < REJECTED).drop(score)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id. Of rows that repeat that id, the one with the least digest stays.

    Rows without an id can't be told apart by the links; they stay.
    """
    found = simhash.near_duplicates(docs)
    kept = found.filter(F.col("doc_id") == F.col("component")).select("doc_id").distinct()
    row = F.struct(*(docs[c] for c in docs.columns))
    numbered = docs.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    once = numbered.groupBy("doc_id").agg(F.min_by(row, mixing.row_digest(docs)).alias("row")).select("row.*")
    return once.unionByName(docs.filter(F.col("doc_id").isNull()))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values are replaced by pseudonyms; n_chars follows the text."""
    changed = pii.pseudonymised(docs)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order; one taken twice is there twice."""
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of tokens."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", simhash_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Toxicity, hashes and tokens can't be expressed in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's rows lie in a folder of this run, which a caller may delete when it has read the result."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

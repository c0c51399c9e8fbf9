"""A training corpus from raw documents: quality rules, near-duplicate removal, masking of personal
data, a source mix by target weights, and packing into token windows.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm import mixing, packing, pii, quality, simhash
from batchlake.llm.queries import DOMAIN, SEED, WEIGHTS, vocabulary
from batchlake.session import materialize

#: Budget of the mix, as a share of all words that reach it. Documents are used once.
SHARE = (9, 10)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the trees fitted on the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_model(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and their new lengths."""
    masked = pii.mask_personal(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.char_length("text").cast(kind))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the hierarchical budget chooses."""
    levels = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix(docs, levels, WEIGHTS, SHARE, epochs=1, seed=SEED).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows."""
    return packing.pack(docs, vocabulary(), end=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: Fingerprints, trees, the CRF and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

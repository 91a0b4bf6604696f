"""The corpus pipeline: language, toxicity, exact copies, near copies, packed sequences.

Each stage gets what the one before kept and returns the rows it keeps with the columns of
``documents``; the last one returns where each piece of a document lies in the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import exact_dedup, language_id, minhash, packing, toxicity
from marginalia.llm.shipping import shipped
from marginalia.sources.paths import stored


@shipped
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language cannot be told go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


@shipped
def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


@shipped
def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


@shipped
def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share four fifths of their five-word shingles the smallest id stays."""
    return minhash.keep_first(docs, minhash.Rule(words=5, percent=80))


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.encode_pieces(docs, with_ids=False)).drop("ids")


STAGES = [
    ("language_id", identify_language),
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("minhash_dedup", remove_near_copies),
    ("packing", pack_sequences),
]

# Trained models and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Token totals by source, language and tokenizer version, kept up by signed changes.

A change says that a document with so many tokens came in (``insert``), went (``delete``), or is
counted anew (``revise``: the old count goes, the new one comes). A batch of changes is reduced to
signed sums for each key before anything is shuffled or stored, and committed as one
partition ``batch=<id>`` of a ledger in shared storage. Totals are the sums over the ledger.

Committing a batch again replaces its partition, also by nothing, so a retry, or a driver that fails
after the write, changes nothing. Writes of different batches do not touch each other. A batch
that would leave a key with fewer than no documents or tokens is refused before it is written.
``compact`` writes a new ledger in which settled batches are one partition; those are closed then.

Defined cases: NULL sources and languages are keys of their own; NULL and empty texts have 0 tokens
but count as documents; texts of any length are counted whole; rows that repeat count as often as
they occur; an empty batch adds nothing; keys whose documents are all gone are left out of the
totals; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.batches import pieces, texts_of
from marginalia.llm.tokens import TOKENIZER, library_encoder
from marginalia.sources.paths import stored

KEY = ["source", "lang", "tokenizer"]
LEDGER = "source string, lang string, tokenizer string, docs long, tokens long, batch string"


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for piece in pieces(batches):
            counts = [len(ids) // 4 for ids in encoder.encode(texts_of(piece))]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in ("doc_id", "source", "lang")), pa.array(counts, pa.int64())],
                names=["doc_id", "source", "lang", "tokens"],
            )

    columns = docs.selectExpr(
        "cast(doc_id as long) as doc_id", "cast(source as string) as source", "cast(lang as string) as lang", "text"
    )
    return columns.mapInArrow(run, "doc_id long, source string, lang string, tokens long").select(
        "doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "tokens"
    )


def _change(counts: DataFrame, docs: int, tokens: Column) -> DataFrame:
    return counts.select(*KEY, F.lit(docs).cast("long").alias("docs"), tokens.cast("long").alias("tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return _change(counts, 1, F.col("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return _change(counts, -1, -F.col("tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old counts out, new ones in; the keys may differ, such as the tokenizer's version."""
    return deletes(before).unionByName(inserts(after))


def commit(spark: SparkSession, ledger: str, batch: str, changes: DataFrame) -> None:
    """Write the batch's sums as its partition of the ledger, in place of an earlier attempt.

    A row of zeros goes along, so that a batch without changes has a partition to write as well.
    """
    entries = _entries(spark, ledger)
    if not entries.filter((F.col("batch") == batch) & F.col("docs").isNull()).isEmpty():
        raise ValueError(f"batch {batch!r} is settled and cannot be committed again")
    nothing = spark.range(1).select(
        *[F.lit(None).cast("string").alias(c) for c in KEY],
        *[F.lit(0).cast("long").alias(c) for c in ("docs", "tokens")],
    )
    sums = stored(_summed(changes.select(*KEY, "docs", "tokens").unionByName(nothing), KEY), "token-sums")
    others = entries.filter(F.col("batch") != batch).drop("batch")
    below = _summed(others.unionByName(sums), KEY).filter("docs < 0 or tokens < 0").first()
    if below is not None:
        raise ValueError(f"batch {batch!r} takes out more than there is, first of {below}")
    sums.withColumn("batch", F.lit(batch)).write.partitionBy("batch").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(ledger)


def compact(spark: SparkSession, ledger: str, target: str, settled: Sequence[str], into: str) -> None:
    """Write to ``target`` the ledger with the ``settled`` batches as one batch ``into``.

    The old ledger stays as it is, so a failure loses nothing and a repetition starts anew. In
    ``target`` the settled batches, marked by an entry without numbers, are refused by ``commit``.
    """
    if into in settled or ledger == target:
        raise ValueError("a compacted ledger needs a folder and a batch name of its own")
    entries = _entries(spark, ledger)
    if not entries.filter(F.col("batch") == into).isEmpty():
        raise ValueError(f"there is a batch {into!r} already")
    closed = F.col("batch").isin(*settled)
    merged = entries.withColumn("batch", F.when(closed, F.lit(into)).otherwise(F.col("batch")))
    marks = entries.filter(closed | F.col("docs").isNull()).select(
        *[F.lit(None).cast("string").alias(c) for c in KEY],
        *[F.lit(None).cast("long").alias(c) for c in ("docs", "tokens")],
        "batch",
    )
    sums = _summed(merged.filter("docs is not null"), [*KEY, "batch"]).unionByName(marks.distinct())
    sums.write.partitionBy("batch").mode("overwrite").parquet(target)


def _summed(entries: DataFrame, by: list[str]) -> DataFrame:
    return entries.groupBy(*by).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def _entries(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], LEDGER)


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """source, lang, tokenizer, docs, tokens; none where nothing was ever committed."""
    return _summed(_entries(spark, ledger), KEY).filter("docs <> 0 or tokens <> 0")

"""Exact duplicates by a tree of merges of sorted digest runs.

Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``. Each text
becomes a digest once; what moves afterwards are narrow rows. Input partitions are dealt
to ``RUNS`` runs. A run holds, sorted by digest, one entry for each of its digests: how many rows
there are and which is the best of them. In each round ``FAN_IN`` neighbouring runs send their
entries for a digest to one place, where they are merged into one entry; after
``log(RUNS) / log(FAN_IN)`` rounds there is one entry for each digest. All merges of a round are spread
over the digests, and a text that a third of all rows share contributes one
entry for each run, never its rows. Equal digests are taken for one text only where the lengths of
the texts agree as well, at every level.

Of equal texts the row with the most code points stays, then the smallest ``doc_id``, then
any one of the rows that agree in both. NULL text counts as empty; a row without ``doc_id``
stays only where no row of its group has one; an empty table gives no rows; other
columns do not matter and are kept by ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"
RUNS = 64
FAN_IN = 8

_KEY = ["text_sha256", "n_left"]


def without_white_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_left (characters the digest saw), n_chars, run, row."""
    bare = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "bare", without_white_space(F.col("text"))
    )
    return bare.select(
        "doc_id",
        F.sha2("bare", 256).alias("text_sha256"),
        F.length("bare").alias("n_left"),
        F.length("text").alias("n_chars"),
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )


def merge_runs(rows: DataFrame) -> DataFrame:
    """One entry for each digest: group_size, keep (struct with doc_id and row of the best row)."""
    best = F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"
    )
    entries = rows.groupBy(*_KEY, "run").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(best).alias("keep")
    )
    left = RUNS
    while left > 1:
        left = -(-left // FAN_IN)
        entries = (
            entries.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int"))
            .groupBy(*_KEY, "run")
            .agg(F.sum("group_size").alias("group_size"), F.min("keep").alias("keep"))
        )
    return entries.drop("run")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row's group: doc_id, keep_id, group_size, kept, text_sha256.

    The digests are stored: both the merges and the look-up of each row's group read them.
    Adaptive execution splits the rows of a frequent digest in that look-up.
    """
    rows = stored(digests(docs), "digests")
    return rows.join(merge_runs(rows), _KEY).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that repeat both the id and the text of the best row are one row afterwards.
    """
    best = merge_runs(digests(docs)).select(
        *[F.col(c).alias(f"__{c}") for c in _KEY],
        F.col("keep.doc_id").alias("__id"),
        (-F.col("keep.shorter")).alias("__n_chars"),
    )
    bare = without_white_space(F.col("text"))
    keyed = docs.withColumns(
        {
            "__text_sha256": F.sha2(bare, 256),
            "__n_left": F.length(bare),
            "__n_chars": F.length(F.coalesce("text", F.lit(""))),
            "__id": F.col("doc_id"),
        }
    )
    same = (
        (keyed["__text_sha256"] == best["__text_sha256"])
        & (keyed["__n_left"] == best["__n_left"])
        & (keyed["__n_chars"] == best["__n_chars"])
        & keyed["__id"].eqNullSafe(best["__id"])
    )
    return keyed.join(best, same, "left_semi").dropDuplicates(["__text_sha256", "__n_left", "__n_chars", "__id"]).select(
        *docs.columns
    )

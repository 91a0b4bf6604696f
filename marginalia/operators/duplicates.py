"""Duplicate texts and duplicates whose labels disagree.

Rows are grouped by a 32-byte digest of the normalised text, so whole texts never cross
the network and a text copied into a third of all rows shrinks to one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent, thousands
from marginalia.functions.text import normalise, text_digest
from marginalia.operators.checks import Check, when_any
from marginalia.operators.once import compute_once

# Fixed value: how many conflicting texts a check counts as reported.
SHOWN_CONFLICTS = 5


def _keyed(df: DataFrame) -> DataFrame:
    """label, text_key and digest of every row."""
    normal = df.select(normalise(F.col("text")).alias("key"), F.col("final_label").alias("label"))
    key = F.col("key")
    return compute_once(normal, ["label"], {"text_key": key, "digest": text_digest(key)})


def duplicate_groups(df: DataFrame) -> DataFrame:
    """digest, copies, conflicting: one row per distinct normalised text.

    Labels are compared by their 64-bit hash, which keeps the aggregate in fixed-width
    buffers (hash, not sort, aggregation).
    """
    label = F.xxhash64("label")
    return (
        _keyed(df)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            (F.min(label) != F.max(label)).alias("conflicting"),
        )
    )


def duplicate_check() -> Check:
    """Over duplicate groups. Every member of a group of two or more counts."""
    rows, copies, shown = F.col("n_rows"), F.col("exact_duplicates"), F.col("label_conflicts")
    return Check(
        name="Duplicate Detection",
        totals={
            "n_rows": F.coalesce(F.sum("copies"), F.lit(0)),
            "exact_duplicates": F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)),
            "label_conflicts_total": F.count_if("conflicting"),
            "label_conflicts": F.least(F.count_if("conflicting"), F.lit(SHOWN_CONFLICTS)),
        },
        figures={
            "exact_duplicates": copies,
            "duplicate_pct": percent(copies, rows),
            "label_conflicts": shown,
            "label_conflicts_total": F.col("label_conflicts_total"),
        },
        passed=copies == 0,
        issues=[
            when_any(
                copies,
                thousands(copies),
                " duplicate texts found (",
                F.col("label_conflicts_total").cast("string"),
                " with conflicting labels)",
            )
        ],
        reason=F.when(rows == 0, "No records to check."),
    )


def check_duplicates(df: DataFrame) -> DataFrame:
    """One row: duplicate rows, their share, conflicts (reported number and true total)."""
    return duplicate_check().run(duplicate_groups(df))


def duplicate_label_conflicts(df: DataFrame, shown: int | None = None) -> DataFrame:
    """All conflicting texts, or the first ``shown`` in key order: text_key, copies, labels.

    Conflicts are found on digests; only rows of a conflicting digest go on with their texts,
    and a text that many rows share is combined before it moves.
    """
    conflicts = duplicate_groups(df).filter("conflicting").select("digest")
    per_label = (
        _keyed(df)
        .join(conflicts, "digest", "left_semi")
        .groupBy("text_key", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = per_label.groupBy("text_key").agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("labels"))
    return found if shown is None else found.orderBy("text_key").limit(shown)

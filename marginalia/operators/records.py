"""Annotation records: the fixed 14-field row every sink and check works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.numbers import round_exact
from marginalia.operators.labelling import label
from marginalia.schemas import RECORD_FIELDS
from marginalia.sources.rules import RuleSet

AUTO_ANNOTATOR = "auto"
# Unit separator: cannot be typed into an id by accident.
_SEPARATOR = "\x1f"


def content_id(*parts: Column) -> Column:
    """The same id for the same content, whatever the partitioning or retry."""
    return F.sha2(F.concat_ws(_SEPARATOR, *parts), 256)


def record_fields(
    df: DataFrame,
    task: str,
    *,
    id_col: str = "_id",
    text_col: str = "_text",
    final: Column | None = None,
    annotator: Column | None = None,
    reviewed: Column | None = None,
    seconds: Column | None = None,
    record_ids: str = "uuid",
) -> DataFrame:
    """Turn labelled rows into records.

    An empty or missing final label falls back to the automatic one; a reviewed row
    whose passed label differs from it, a missing one included, is an override.
    ``record_ids="uuid"`` gives every row its own id; ``"content"`` hashes task, source
    id, annotator and text, so equal rows share an id and reruns reproduce it.
    """
    auto = F.col("auto_label")
    passed = F.lit(None).cast("string") if final is None else final
    who = F.lit(AUTO_ANNOTATOR) if annotator is None else annotator
    seen = F.lit(False) if reviewed is None else reviewed
    took = F.lit(0.0) if seconds is None else seconds
    source_id, text = F.col(id_col).cast("string"), F.col(text_col)
    if record_ids not in ("uuid", "content"):
        raise ValueError("record_ids must be 'uuid' or 'content'")
    record_id = F.uuid() if record_ids == "uuid" else content_id(F.lit(task), source_id, who, text)
    return df.select(
        record_id.alias("record_id"),
        source_id.alias("source_id"),
        text.alias("text"),
        F.lit(task).alias("task"),
        auto.alias("auto_label"),
        F.col("auto_confidence"),
        F.col("auto_signals"),
        F.coalesce(F.nullif(passed, F.lit("")), auto).alias("final_label"),
        who.alias("annotator"),
        seen.alias("is_human_reviewed"),
        (seen & ~passed.eqNullSafe(auto)).alias("human_override"),
        round_exact(took, 3).alias("annotation_time_sec"),
        F.current_timestamp().alias("created_at"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def record_view(df: DataFrame) -> DataFrame:
    """The 14 record fields in their fixed order."""
    return df.select(*RECORD_FIELDS)


def label_batch(df: DataFrame, rule_set: RuleSet, record_ids: str = "uuid") -> DataFrame:
    """Cleaned rows (``_id``, ``_text``) to unreviewed records; modes auto and batch alike."""
    return record_fields(label(df, rule_set, "_text"), rule_set.task, record_ids=record_ids)

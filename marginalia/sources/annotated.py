"""Annotated tables for quality checks: renamed, checked and typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marginalia.functions.numbers import coerce_bool, coerce_confidence
from marginalia.sources.paths import suffix_of
from marginalia.sources.readers import FORMATS, scan

# What a quality check needs, and other accepted spellings, tried in order.
REQUIRED_COLUMNS = ["text", "final_label", "auto_label", "auto_confidence"]
GOLD_COLUMNS = ["source_id", "final_label"]
COLUMN_ALIASES = {
    "label": "final_label",
    "prediction": "auto_label",
    "confidence": "auto_confidence",
    "content": "text",
    "review": "text",
    "comment": "text",
}
FLAG_COLUMNS = ["is_human_reviewed", "human_override"]


def alias_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case names, then rename aliases whose canonical name is absent."""
    names = [c.strip().lower() for c in df.columns]
    for alias, canonical in COLUMN_ALIASES.items():
        if alias in names and canonical not in names:
            names[names.index(alias)] = canonical
    return df.toDF(*names)


def missing_columns(columns: list[str], required: list[str] | None = None) -> list[str]:
    return sorted(set(required or REQUIRED_COLUMNS) - set(columns))


def conform(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Any table of strings to an annotated table."""
    renamed = alias_columns(df)
    missing = missing_columns(renamed.columns, required)
    if missing:
        raise KeyError(f"missing required columns {missing}; got {renamed.columns}")
    typed = {c: coerce_bool(renamed[c]) for c in FLAG_COLUMNS if c in renamed.columns}
    if "auto_confidence" in renamed.columns:
        typed["auto_confidence"] = coerce_confidence(renamed["auto_confidence"].cast("string"))
    return renamed.withColumns(typed)


def scan_annotated(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Any file or folder ``readers.scan`` opens, CSV where neither ``format`` nor its suffix tells."""
    return conform(_scan_table(spark, path, multi_line, format, schema))


def scan_gold(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """A gold file needs only an id and the true label."""
    return conform(_scan_table(spark, path, multi_line, format, schema), GOLD_COLUMNS)


def _scan_table(spark, path, multi_line, format, schema) -> DataFrame:
    known = format or ("csv" if suffix_of(path).lstrip(".") not in FORMATS else None)
    return scan(spark, path, multi_line, known, schema)

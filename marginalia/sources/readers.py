"""Text table sources: CSV, TSV, JSON, JSON lines and parquet, cleaned to ``_id``, ``_text``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginalia.functions.text import strip
from marginalia.operators.prefix import by_range, with_totals_before
from marginalia.sources.layout import largest_file, split_bound, split_bytes
from marginalia.sources.paths import require_path, suffix_of
from marginalia.sources.splitcsv import read_split_csv

# Accepted column names, best first.
TEXT_COLUMNS = [
    "text", "content", "review", "comment", "message",
    "description", "title", "post", "tweet", "body",
    "review_text", "review_body", "sentence", "document",
]
ID_COLUMNS = ["id", "review_id", "post_id", "comment_id", "item_id"]

# Where a row stands: its file, the split of it, and its place there.
ORIGIN = ["__file", "__block", "__pos"]

_PLAIN_PATH = re.compile(r"[\w./:=+-]+", re.ASCII)

# Splits of some 200 bytes each that are still broadcast (about 40 MB).
MAX_BROADCAST_SPLITS = 200_000


def _all_text(df: DataFrame) -> DataFrame:
    """Every column as string, missing as empty."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def scan_csv(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = True, origin: bool = False
) -> DataFrame:
    """Header row, every column a string, empty stays empty, quotes doubled inside quotes.

    Quoted line breaks are understood, and files larger than a split are still read in many tasks (see
    ``splitcsv``). ``multi_line=False`` spares files without such breaks the pass that
    looks for them. ``origin`` keeps what that way of reading knows of the order of rows.
    """
    reader = spark.read.options(
        header=True, sep=sep, quote='"', escape='"', multiLine=multi_line, inferSchema=False,
        enforceSchema=False,  # files whose header differs are refused, not misread
    )
    plain = reader.csv(path)
    if not multi_line or largest_file(spark, path) <= split_bytes(spark):
        return _all_text(plain)
    rows = read_split_csv(spark, path, plain.columns, sep)
    texts = _all_text(rows.select(*plain.columns))
    if not origin:
        return texts
    return rows.select(*ORIGIN, *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in plain.columns])


def scan_tsv(spark: SparkSession, path: str, multi_line: bool = True, origin: bool = False) -> DataFrame:
    return scan_csv(spark, path, sep="\t", multi_line=multi_line, origin=origin)


def scan_json_array(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Files that each hold one JSON array of records. A schema saves the pass that infers one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _all_text(reader.json(path, multiLine=True, primitivesAsString=True))


def scan_jsonl(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """One JSON record per line; splits at any size. A schema saves the pass that infers one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _all_text(reader.json(path, primitivesAsString=True))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _all_text(spark.read.parquet(path))


FORMATS = ["csv", "tsv", "json", "jsonl", "ndjson", "parquet"]


def scan(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
    origin: bool = False,
) -> DataFrame:
    """Pick the reader by ``format``, else by the lower-cased suffix.

    ``format`` also opens folders that a writer made. ``multi_line`` matters to CSV and TSV,
    ``schema`` to JSON.
    """
    require_path(spark, path)
    found = format or suffix_of(path).lstrip(".")
    if found not in FORMATS:
        raise ValueError(f"unsupported format {found!r}; use one of {FORMATS}")
    if found in ("csv", "tsv"):
        return (scan_csv if found == "csv" else scan_tsv)(spark, path, multi_line=multi_line, origin=origin)
    if found == "parquet":
        return scan_parquet(spark, path)
    return (scan_json_array if found == "json" else scan_jsonl)(spark, path, schema)


def _detect(columns: list[str], wanted: list[str]) -> str | None:
    by_lower = {c.lower(): c for c in columns}
    return next((by_lower[name] for name in wanted if name in by_lower), None)


def detect_text_column(columns: list[str], text_col: str | None = None) -> str:
    """An explicit name is case-sensitive; otherwise the first known name, in list order."""
    found = text_col if text_col in columns else None
    if text_col is None:
        found = _detect(columns, TEXT_COLUMNS)
    if found is None:
        raise KeyError(f"no text column ({text_col or 'none of the known names'}) among {columns}")
    return found


def detect_id_column(columns: list[str], id_col: str | None = None) -> str | None:
    """As for text, but None where no known name is present."""
    if id_col is not None and id_col not in columns:
        raise KeyError(f"no id column {id_col!r} among {columns}")
    return id_col or _detect(columns, ID_COLUMNS)


def _with_origin(df: DataFrame) -> DataFrame:
    """Tag rows with their file split and a position that grows in file order inside it.

    Must be applied straight to a reader's output: both are facts of the scan. The reader of
    split CSV files has told them already.
    """
    if set(ORIGIN) <= set(df.columns):
        return df
    return df.withColumns(
        {
            "__file": F.when(F.input_file_name() != "", F.input_file_name()).otherwise(
                F.raise_error(F.lit("rows can only be numbered or limited straight off a reader"))
            ),
            "__block": F.input_file_block_start().cast("long"),
            "__pos": F.monotonically_increasing_id(),
        }
    )


def _split_offsets(df: DataFrame) -> DataFrame:
    """Per file split: its first position and how many rows of ``df`` come before it."""
    splits = df.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__pos").alias("__first")
    )
    order = ["__file", "__block"]
    offsets = with_totals_before(by_range(splits, order, "splits"), order, "__rows", "__before").drop("__rows")
    # One short row per split. Within the bound, tell the planner: its own estimate is that
    # of the whole table, and it would shuffle the texts to meet these rows.
    bound = split_bound(df)
    return F.broadcast(offsets) if bound is not None and bound <= MAX_BROADCAST_SPLITS else offsets


def _number_rows(df: DataFrame, name: str) -> DataFrame:
    """Number rows 0..n-1 in file order: position in the split plus rows before the split."""
    ordinal = F.col("__pos") - F.col("__first") + F.col("__before")
    return (
        df.join(_split_offsets(df), ["__file", "__block"])
        .withColumn(name, ordinal)
        .drop("__first", "__before")
    )


def _first_rows(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in file order.

    Whole splits beyond the limit go first; only what is left is ranked, split by split.
    """
    reachable = df.join(_split_offsets(df), ["__file", "__block"]).filter(F.col("__before") < limit)
    rank = F.row_number().over(Window.partitionBy("__file", "__block").orderBy("__pos"))
    return (
        reachable.withColumn("__rank", rank)
        .filter(F.col("__rank") <= limit)  # lets each task keep the first rows of a split only
        .filter(F.col("__before") + F.col("__rank") <= limit)
        .drop("__first", "__before", "__rank")
    )


def _first_files(df: DataFrame, has_text: Column, limit: int) -> DataFrame:
    """``df`` without the files that lie behind the first ``limit`` rows with text.

    Counting stops at the limit in every task, and files that are not asked for are not opened.
    """
    files = sorted(df.inputFiles())
    # Names that are spelled alike as paths and as addresses.
    if len(files) < 2 or not all(_PLAIN_PATH.fullmatch(f) for f in files):
        return df
    name = F.col("_metadata.file_path")
    taken = 1
    while taken < len(files):
        # An address without a host has three slashes here and one there.
        few = df.filter(name.isin([*files[:taken], *[f.replace(":///", ":/", 1) for f in files[:taken]]]))
        if few.filter(has_text).limit(limit).count() == limit:
            return few
        taken *= 8
    return df


def clean(
    df: DataFrame,
    text_col: str | None = None,
    id_col: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add ``_id`` and ``_text``, drop rows without text, keep the first ``limit`` of the rest.

    Without an id column rows are numbered in file order before the empty ones go, so
    ids may keep gaps; that and ``limit`` need ``df`` to come straight from a reader and
    cost one extra narrow pass each. Prefer a table with an id at scale.
    """
    names = [c for c in df.columns if c not in ORIGIN]
    text_name = detect_text_column(names, text_col)
    id_name = detect_id_column(names, id_col)
    text = strip(F.coalesce(F.col(f"`{text_name}`").cast("string"), F.lit("")))
    if limit and not set(ORIGIN) <= set(df.columns):
        df = _first_files(df, F.char_length(text) > 0, limit)
    if id_name is None or limit:
        df = _with_origin(df)
    if id_name is None:
        df = _number_rows(df, "__ordinal")
        id_name = "__ordinal"
    cleaned = df.withColumns({"_text": text, "_id": F.col(f"`{id_name}`").cast("string")}).filter(
        F.char_length("_text") > 0
    )
    if limit:
        cleaned = _first_rows(cleaned, limit)
    return cleaned.drop(*ORIGIN, "__ordinal")


def load(
    spark: SparkSession,
    path: str,
    text_col: str | None = None,
    id_col: str | None = None,
    limit: int | None = None,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Read any supported file or folder and clean it; see ``scan`` for the last three."""
    return clean(scan(spark, path, multi_line, format, schema, origin=True), text_col, id_col, limit)

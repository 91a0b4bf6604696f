"""Duplicates of a new batch among everything labelled before, from an index of text digests.

The index is a Parquet table bucketed by digest, with one partition per batch. A new batch
brings its digests to the buckets, so the old ones are read where they lie and never shuffled. A
batch that is added again takes the place of its former rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent, thousands
from marginalia.functions.text import normalise
from marginalia.operators.checks import Check, when_any
from marginalia.sources.paths import require_path

BUCKETS = 64


def open_index(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Name the index at ``path`` in this session; a new path starts an empty one.

    ``buckets`` belongs to the index: open it with the number it was made with.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, label STRING, n BIGINT, batch STRING) USING parquet "
        f"PARTITIONED BY (batch) CLUSTERED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    try:
        require_path(spark, path)
    except FileNotFoundError:
        return
    spark.sql(f"MSCK REPAIR TABLE {name}")


def digest_labels(df: DataFrame, text_col: str = "text", label_col: str = "final_label") -> DataFrame:
    """digest, label, n: how often each normalised text has each label. NULL counts as the empty text."""
    digest = F.sha2(normalise(F.coalesce(F.col(text_col), F.lit(""))), 256)
    return (
        df.select(digest.alias("digest"), F.col(label_col).cast("string").alias("label"))
        .groupBy("digest", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def add_batch(spark: SparkSession, name: str, batch: str, df: DataFrame, buckets: int = BUCKETS) -> None:
    """Put a batch into the index, instead of what it had there under its name (word characters, dots, dashes)."""
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    rows = digest_labels(df)
    # A row that says nothing stands for the batch itself: an empty one replaces its former rows, too.
    mark = spark.createDataFrame([(None, None, 0)], rows.schema)
    rows = rows.unionByName(mark).repartition(buckets, "digest")
    # Names its partition, so that no other one is touched.
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (batch = '{batch}') SELECT digest, label, n FROM {{rows}}", rows=rows
    )


def duplicates_with_history(
    spark: SparkSession, name: str, df: DataFrame, batch: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """digest, copies, earlier, labels, conflicting: one row per text of ``df``.

    ``copies`` are in ``df``, ``earlier`` ones in the index; ``labels`` counts the different labels of all
    of them. With ``batch``, rows that the index has under that name are left out.
    """
    new = digest_labels(df)
    old = spark.table(name).filter("digest IS NOT NULL")
    if batch is not None:
        old = old.filter(F.col("batch") != batch)
    # As many partitions as buckets: the planner then has no reason to deal the old rows anew.
    asked = new.select("digest").repartition(buckets, "digest").distinct()
    # Only old rows of texts that came again go on from here.
    met = old.join(asked, "digest", "left_semi").select("digest", "label", F.lit(0).cast("long").alias("n"), F.col("n").alias("before"))
    every = new.withColumn("before", F.lit(0).cast("long")).unionByName(met)
    per_label = every.groupBy("digest", "label").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
    return per_label.groupBy("digest").agg(
        F.sum("n").alias("copies"),
        F.sum("before").alias("earlier"),
        F.count("label").alias("labels"),
        (F.count("label") > 1).alias("conflicting"),
    )


def history_check() -> Check:
    """Over ``duplicates_with_history``: a row counts when its text was there before, or twice in the batch."""
    rows, again, clash = F.col("n_rows"), F.col("seen_before"), F.col("conflicting_texts")
    return Check(
        name="Duplicates With History",
        totals={
            "n_rows": F.coalesce(F.sum("copies"), F.lit(0)),
            "seen_before": F.coalesce(F.sum(F.when(F.col("earlier") > 0, F.col("copies"))), F.lit(0)),
            "duplicates": F.coalesce(F.sum(F.when(F.col("earlier") + F.col("copies") > 1, F.col("copies"))), F.lit(0)),
            "conflicting_texts": F.count_if("conflicting"),
        },
        figures={
            "seen_before": again,
            "seen_before_pct": percent(again, rows),
            "duplicates": F.col("duplicates"),
            "conflicting_texts": clash,
        },
        passed=F.col("duplicates") == 0,
        issues=[
            when_any(again, thousands(again), " texts were labelled before"),
            when_any(clash, thousands(clash), " texts have conflicting labels"),
        ],
        reason=F.when(rows == 0, "No records to check."),
    )


def check_with_history(
    spark: SparkSession, name: str, df: DataFrame, batch: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    return history_check().run(duplicates_with_history(spark, name, df, batch, buckets))

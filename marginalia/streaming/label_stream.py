"""Structured Streaming: the batch labelling projection over an unbounded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marginalia.operators.labelling import label
from marginalia.sources.rules import RuleSet


def label_stream(stream: DataFrame, rule_set: RuleSet, text_col: str = "text") -> DataFrame:
    """Stateless and narrow: exactly the batch operator, any trigger, append output."""
    return label(stream, rule_set, text_col)


def windowed_label_counts(
    labelled: DataFrame,
    time_col: str,
    label_col: str = "auto_label",
    window: str = "1 hour",
    lateness: str = "1 hour",
) -> DataFrame:
    """Labels per event-time window; state is one row per open window and label.

    Rows later than ``lateness`` behind the newest event are dropped by the watermark.
    Works on batch tables too, where the watermark has no effect.
    """
    return (
        labelled.withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, window).alias("w"), F.col(label_col).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "label", "n")
    )


_COUNTS = "window_start timestamp, label string, n long, batch long"


def count_windows(
    labelled: DataFrame,
    folder: str,
    progress: str,
    time_col: str,
    label_col: str = "auto_label",
    window: str = "1 hour",
) -> StreamingQuery:
    """Start counting labels per window into ``folder``, whatever order the rows come in.

    Every micro-batch adds its own counts as one partition. A batch that is run again after a
    failure replaces its partition, so no row counts twice; rows are never too late, and no
    state is kept. ``window_totals`` adds the batches up.
    """

    def add(batch: DataFrame, number: int) -> None:
        counts = windowed_label_counts(batch, time_col, label_col, window)
        counts.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return (
        labelled.writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def window_totals(spark: SparkSession, folder: str) -> DataFrame:
    """window_start, label, n over all batches so far: open windows too."""
    counts = spark.read.schema(_COUNTS).parquet(folder)
    return counts.groupBy("window_start", "label").agg(F.sum("n").alias("n"))

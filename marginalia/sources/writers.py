"""Sinks: flat CSV, nested JSON lines, review-tool tasks, summaries and check results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import __version__
from marginalia.operators.review import REVIEW_THRESHOLD, review_queue
from marginalia.operators.summary import annotation_summary
from marginalia.schemas import RECORD_FIELDS
from marginalia.sources.rules import RuleSet

MODEL_VERSION = f"rule_engine_v{__version__}"
# Names the review tool expects in a choice result.
CHOICE = {"from_name": "label", "to_name": "text", "type": "choices"}
REVIEW_TOOL_MODES = ("ls", "label_studio", "all")


def _iso(ts: Column) -> Column:
    """UTC ISO-8601 text, whatever the session time zone."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _python_bool(flag: Column) -> Column:
    return F.when(flag, "True").otherwise("False")


def flat_records(records: DataFrame, labels: list[str]) -> DataFrame:
    """All-scalar form: the signals map becomes one trailing column per label."""
    shaped = {
        "is_human_reviewed": _python_bool(F.col("is_human_reviewed")),
        "human_override": _python_bool(F.col("human_override")),
        "created_at": _iso(F.col("created_at")),
        "metadata": F.to_json("metadata"),
    }
    return records.select(
        *[shaped.get(c, F.col(c)).alias(c) for c in RECORD_FIELDS if c != "auto_signals"],
        *[F.col("auto_signals")[label].alias(f"signal_{label}") for label in labels],
    )


def write_csv(records: DataFrame, path: str, labels: list[str]) -> str:
    # Spark trims values and marks empties on write unless told otherwise.
    flat_records(records, labels).write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def write_jsonl(records: DataFrame, path: str) -> str:
    nested = records.select(*RECORD_FIELDS).withColumn("created_at", _iso(F.col("created_at")))
    nested.write.json(path, ignoreNullFields=False)
    return path


def _choice(label: Column, *extra: Column) -> Column:
    return F.struct(
        *[F.lit(v).alias(k) for k, v in CHOICE.items()],
        F.struct(F.array(label).alias("choices"), *extra).alias("value"),
    )


def review_tasks(records: DataFrame, task: str) -> DataFrame:
    """One review-tool task per record: the text, the final label, and the prediction."""
    score = F.col("auto_confidence")
    annotation = F.struct(
        F.col("record_id").alias("id"),
        _iso(F.col("created_at")).alias("created_at"),
        F.array(_choice(F.col("final_label"), score.alias("confidence"))).alias("result"),
        F.lit(False).alias("was_cancelled"),
        F.lit(False).alias("ground_truth"),
        F.col("annotation_time_sec").alias("lead_time"),
    )
    prediction = F.struct(
        F.lit(MODEL_VERSION).alias("model_version"),
        score.alias("score"),
        F.array(_choice(F.col("auto_label"))).alias("result"),
    )
    return records.select(
        F.col("source_id").alias("id"),
        F.struct("text", "source_id", F.lit(task).alias("task_type")).alias("data"),
        F.array(annotation).alias("annotations"),
        F.array(prediction).alias("predictions"),
    )


def _closer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives the batches as they are, holds none, and adds a last row that ends the array."""

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, schema = "[]", pa.schema([("value", pa.string())])
        for batch in batches:
            if batch.num_rows:
                last, schema = "]", batch.schema
                yield batch
            del batch
        yield pa.RecordBatch.from_arrays([pa.array([last], schema.field(0).type)], schema=schema)

    return closed


def write_json_array(df: DataFrame, path: str) -> str:
    """Part files that each hold one JSON array, for tools that import arrays.

    Lines get their bracket or comma in Spark and stream through Python, which only adds the end.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    # The lower 33 bits count the rows of a partition.
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    opener = F.when(is_first, "[").otherwise(",")
    lines = df.select(F.concat(opener, F.to_json(F.struct("*"), keep_nulls)).alias("value"))
    lines.mapInArrow(_closer(), "value string").write.text(path)
    return path


def write_review_tasks(records: DataFrame, path: str, task: str) -> str:
    """One JSON array of tasks per part file, which is what the review tool imports."""
    return write_json_array(review_tasks(records, task), path)


def write_review_queue(records: DataFrame, path: str, threshold: float = REVIEW_THRESHOLD) -> str:
    """What a reviewer should see, least certain first, as JSON lines."""
    queue = review_queue(records, threshold, "source_id")
    queue.select("source_id", "text", "task", "auto_label", "auto_confidence").write.json(path, ignoreNullFields=False)
    return path


def write_summary(records: DataFrame, path: str) -> str:
    summary = annotation_summary(records).withColumn("generated_at", _iso(F.col("generated_at")))
    summary.write.json(path, ignoreNullFields=False)
    return path


def export(
    spark: SparkSession,
    records: DataFrame,
    folder: str,
    rule_set: RuleSet,
    mode: str = "csv",
    review_below: float | None = None,
) -> dict[str, str]:
    """Write every output of a labelling run; review-tool tasks only where asked for, and the queue of
    items under the confidence ``review_below`` where that is given.

    The records are computed once, into parquet. Each further sink reads that table, so
    ids and times agree between outputs and a lost executor costs a re-read, not a rerun.
    """
    paths = {"records": f"{folder}/records"}
    records.write.parquet(paths["records"])
    stored = spark.read.schema(records.schema).parquet(paths["records"])
    paths["csv"] = write_csv(stored, f"{folder}/csv", rule_set.labels)
    paths["jsonl"] = write_jsonl(stored, f"{folder}/jsonl")
    if mode in REVIEW_TOOL_MODES:
        paths["review_tasks"] = write_review_tasks(stored, f"{folder}/review_tasks", rule_set.task)
    if review_below is not None:
        paths["review_queue"] = write_review_queue(stored, f"{folder}/review_queue", review_below)
    paths["summary"] = write_summary(stored, f"{folder}/summary")
    return paths


def write_check_results(checks: DataFrame, metrics: DataFrame, folder: str, input_name: str) -> dict[str, str]:
    """Check rows and their long-form metrics, stamped with time and input name."""
    paths = {"checks": f"{folder}/checks", "metrics": f"{folder}/metrics"}
    stamp = [_iso(F.current_timestamp()).alias("generated_at"), F.lit(input_name).alias("input")]
    checks.select(*stamp, "*").write.json(paths["checks"], ignoreNullFields=False)
    metrics.select(*stamp, "*").write.json(paths["metrics"], ignoreNullFields=False)
    return paths

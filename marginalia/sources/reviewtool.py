"""Read corrected tasks back from the review tool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

_VALUE = StructType(
    [StructField("choices", ArrayType(StringType())), StructField("confidence", DoubleType())]
)
_RESULT = ArrayType(StructType([StructField("type", StringType()), StructField("value", _VALUE)]))
REVIEW_TASK = StructType(
    [
        StructField("id", StringType()),
        StructField(
            "data",
            StructType([StructField(c, StringType()) for c in ("text", "source_id", "task_type")]),
        ),
        StructField(
            "annotations",
            ArrayType(
                StructType(
                    [
                        StructField("id", StringType()),
                        StructField("created_at", StringType()),
                        StructField("result", _RESULT),
                        StructField("was_cancelled", BooleanType()),
                        StructField("lead_time", DoubleType()),
                    ]
                )
            ),
        ),
        StructField(
            "predictions",
            ArrayType(StructType([StructField("score", DoubleType()), StructField("result", _RESULT)])),
        ),
    ]
)


def import_review_tasks(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Task documents to annotated rows ready for the checks.

    One row per annotation that was not cancelled; its first choice is the final label,
    the prediction's first choice the automatic one. Fixed schema: no inference pass.
    ``multi_line`` reads files that hold one JSON array each, as the tool exports them; without it
    there is one task per line. What turns out to be neither is an error.
    """
    tasks = spark.read.schema(REVIEW_TASK).json(path, multiLine=multi_line)
    is_task = F.col("id").isNotNull() | F.col("data").isNotNull()
    wrong = F.raise_error(F.lit("a line that is no task; pass multi_line=True for JSON arrays"))
    tasks = tasks.filter(F.when(is_task, F.lit(True)).otherwise(wrong.cast("boolean")))
    prediction = F.get("predictions", F.lit(0))
    auto = F.get(F.get(prediction["result"], F.lit(0))["value"]["choices"], F.lit(0))
    rows = tasks.select(
        F.coalesce("data.source_id", "id").alias("source_id"),
        F.col("data.text").alias("text"),
        F.col("data.task_type").alias("task"),
        auto.alias("auto_label"),
        F.coalesce(prediction["score"], F.lit(0.0)).alias("auto_confidence"),
        F.explode("annotations").alias("a"),
    ).filter(~F.coalesce("a.was_cancelled", F.lit(False)))
    final = F.get(F.get(F.col("a.result"), F.lit(0))["value"]["choices"], F.lit(0))
    return rows.select(
        "source_id",
        "text",
        "task",
        "auto_label",
        "auto_confidence",
        F.coalesce(final, F.col("auto_label")).alias("final_label"),
        F.lit(True).alias("is_human_reviewed"),
        F.coalesce(final != F.col("auto_label"), F.lit(False)).alias("human_override"),
        F.coalesce("a.lead_time", F.lit(0.0)).alias("annotation_time_sec"),
        F.col("a.created_at").alias("created_at"),
    )

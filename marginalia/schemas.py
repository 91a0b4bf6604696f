"""Row shapes shared by the operators."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RULE_TABLE = StructType(
    [
        StructField("task", StringType(), False),
        StructField("label", StringType(), False),
        StructField("label_ord", IntegerType(), False),
        StructField("signal_ord", IntegerType(), False),
        StructField("pattern", StringType(), False),
    ]
)

RECORD = StructType(
    [
        StructField("record_id", StringType()),
        StructField("source_id", StringType()),
        StructField("text", StringType()),
        StructField("task", StringType()),
        StructField("auto_label", StringType()),
        StructField("auto_confidence", DoubleType()),
        StructField("auto_signals", MapType(StringType(), IntegerType())),
        StructField("final_label", StringType()),
        StructField("annotator", StringType()),
        StructField("is_human_reviewed", BooleanType()),
        StructField("human_override", BooleanType()),
        StructField("annotation_time_sec", DoubleType()),
        StructField("created_at", TimestampType()),
        StructField("metadata", MapType(StringType(), StringType())),
    ]
)

RECORD_FIELDS = RECORD.fieldNames()

DECISION = StructType(
    [
        StructField("source_id", StringType()),
        StructField("choice", StringType()),
        StructField("annotator", StringType()),
        StructField("time_sec", DoubleType()),
        StructField("seq", LongType()),
    ]
)

GOLD = StructType(
    [
        StructField("source_id", StringType(), False),
        StructField("text", StringType(), False),
        StructField("final_label", StringType(), False),
    ]
)

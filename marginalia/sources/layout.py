"""Spreading inputs that are too small to split by themselves."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default size of one file split in Spark.
ONE_SPLIT = 128 * 1024 * 1024

# Spark's default broadcast limit, where the session spells its own with a unit.
BROADCAST_LIMIT = 10 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int | None:
    """Spark's own size estimate of a DataFrame, None where it is not to be had."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # noqa: BLE001 - e.g. a remote session without a JVM handle
        return None


def spread(df: DataFrame) -> DataFrame:
    """Give a one-split input to every core before expensive row work.

    A parquet row group cannot be split, so a small file would be labelled by one core.
    Inputs above one read split are left exactly as they are: they come in many splits,
    and their texts are not worth moving.
    """
    spark = df.sparkSession
    size = planned_bytes(df)
    if size is None or size > ONE_SPLIT:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def split_bound(df: DataFrame) -> int | None:
    """At most how many file splits a scanned DataFrame has, None where unknown."""
    size = planned_bytes(df)
    return None if size is None else size // (ONE_SPLIT // 4) + 2 * len(df.inputFiles())


def small_enough(df: DataFrame) -> bool:
    """Whether the planner would broadcast a table of this estimated size."""
    size = planned_bytes(df)
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").lower()
    limit_bytes = int(limit.rstrip("b")) if limit.rstrip("b").lstrip("-").isdigit() else BROADCAST_LIMIT
    return size is not None and size <= limit_bytes


def split_bytes(spark: SparkSession) -> int:
    """The session's bound on one file split."""
    told = spark.conf.get("spark.sql.files.maxPartitionBytes", str(ONE_SPLIT)).strip().lower()
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", told).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file at a path; only the listing is read."""
    sizes = spark.read.format("binaryFile").load(path).select("length")
    return sizes.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]

"""Path checks and shared scratch space, through Spark's own file systems."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def require_path(spark: SparkSession, path: str) -> None:
    """FileNotFoundError unless the path exists on whatever file system it names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            raise FileNotFoundError(f"no such input: {path}") from error
        raise


def suffix_of(path: str) -> str:
    """Lower-cased extension of the last path segment, with its dot."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared storage in ``spark.checkpoint.dir``. Where that is unset, a
    session on one machine (a ``local`` master) uses that machine's temporary folder; any
    other is refused, because each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/marginalia-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once to shared storage and read it back.

    For results that several jobs use: they survive lost executors, each reader fetches
    only the columns it asks for, and the planner knows their true size.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)

"""Bounded, repeatable samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_class(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About ``most`` rows of each class, and never more; all rows of smaller classes.

    Class sizes are counted first, so that only some twice ``most`` rows of a class, those
    with the least hashes of ``key``, are ranked. Adds ``class_size``.
    """
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("class_size"))
    hashed = F.xxhash64(F.col(key), F.lit("sample"))
    spread = F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30))
    first = F.row_number().over(Window.partitionBy(label).orderBy("__hash", key))
    return (
        rows.join(F.broadcast(sizes), label)
        .withColumn("__hash", hashed)
        .filter(spread * F.col("class_size") < 2.0 * most)
        .withColumn("__nth", first)
        .filter(F.col("__nth") <= most)
        .drop("__hash", "__nth")
    )


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))

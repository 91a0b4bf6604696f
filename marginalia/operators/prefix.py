"""Running totals over ordered rows without a window over all of them.

Rows are dealt into ranges, each range is summed, and a window over one row per range gives
what comes before it; inside a range an ordinary window adds the rest. No task sees more than one range
or the range totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

RANGE = "__range"


def by_range(df: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """Rows stored in ranges of about equal size, numbered in ``order`` in the column RANGE.

    Borders come from a sample, so the rows are written once and stay where they are.
    """
    return stored(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), purpose)


def with_totals_before(ranged: DataFrame, order: list[str], amount: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows that come earlier in ``order``.

    ``ranged`` has a column RANGE that never falls as ``order`` rises and takes a bounded number of
    values; ``order`` tells rows apart. RANGE goes.
    """
    totals = ranged.groupBy(RANGE).agg(F.sum(amount).alias("__sum"))
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(RANGE, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, far below any broadcast limit: ranges are partitions or fixed buckets.
    return (
        ranged.join(F.broadcast(starts), RANGE)
        .withColumn(name, F.col("__start") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop(RANGE, "__start")
    )

"""Sample texts and gold items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.schemas import GOLD
from marginalia.sources.vocabulary import GOLD_ITEMS, SAMPLE_TEXTS

DEFAULT_TASK = "sentiment"


def sample_texts(df: DataFrame, task: str, index: Column) -> DataFrame:
    """One sample row (id, text) per input row, cycling the seed texts by a 0-based index.

    From the second cycle on a suffix keeps texts distinct. The seeds are a literal
    array, so this is a projection.
    """
    seeds = SAMPLE_TEXTS.get(task, SAMPLE_TEXTS[DEFAULT_TASK])
    k, number = len(seeds), (index + 1).cast("string")
    seed = F.array(*[F.lit(s) for s in seeds])[(index % k).cast("int")]
    suffix = F.when(index >= k, F.concat(F.lit(" (sample #"), number, F.lit(")"))).otherwise("")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return df.select(
        F.concat(F.lit(f"{task}_"), padded).alias("id"), F.concat(seed, suffix).alias("text")
    )


def generate_samples(spark: SparkSession, task: str, n: int = 100) -> DataFrame:
    return sample_texts(spark.range(n), task, F.col("id"))


def gold_items(spark: SparkSession, task: str) -> DataFrame:
    """The built-in gold items of a task; an unknown task gets the default ones."""
    return spark.createDataFrame(GOLD_ITEMS.get(task, GOLD_ITEMS[DEFAULT_TASK]), GOLD)

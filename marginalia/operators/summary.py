"""Run summaries, all derived from one small contingency table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia import __version__
from marginalia.functions.numbers import percent, round_exact
from marginalia.operators.median import exact_median
from marginalia.sources.paths import stored

# Fixed value: what the summary calls low confidence (the review threshold is another).
LOW_CONFIDENCE = 0.2

PROFILE_KEYS = ["task", "final_label", "auto_label", "auto_confidence", "is_human_reviewed", "human_override"]


def label_profile(records: DataFrame) -> DataFrame:
    """Row counts per combination of labels, confidence and review flags.

    Rule confidences take only a few values per label, so this collapses any number of
    records in the map-side aggregate; every summary figure follows from the result.
    """
    return records.groupBy(*PROFILE_KEYS).agg(F.count(F.lit(1)).alias("n"))


def label_counts(records: DataFrame, label_col: str = "final_label") -> DataFrame:
    return records.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def label_shares(records: DataFrame, label_col: str = "final_label") -> DataFrame:
    """Labels by descending count with their share in percent (1 decimal)."""
    # The window covers one row per label, after aggregation.
    total = F.sum("count").over(Window.partitionBy())
    return (
        label_counts(records, label_col)
        .withColumn("pct", percent(F.col("count"), total, 1))
        .orderBy(F.desc("count"), "label")
    )


def confidence_stats(records: DataFrame) -> DataFrame:
    """One row: mean, median, min, max (4 decimals) and share of exact zeros (2)."""
    profile = stored(label_profile(records), "profile")
    return _with_median(profile.agg(*_stat_columns()), profile).select("mean", "median", "min", "max", "pct_zero")


def review_stats(records: DataFrame) -> DataFrame:
    """One row: reviewed and overridden counts, overrides in percent of reviewed."""
    reviewed, overrides = F.count_if("is_human_reviewed"), F.count_if("human_override")
    return records.agg(
        reviewed.alias("reviewed_count"),
        overrides.alias("override_count"),
        percent(overrides, reviewed).alias("override_rate_pct"),
    )


def quality_flags(records: DataFrame) -> DataFrame:
    c = F.col("auto_confidence")
    return records.agg(
        F.count_if((c > 0) & (c < LOW_CONFIDENCE)).alias("low_confidence_count"),
        F.count_if(c == 0).alias("zero_signal_count"),
        F.count_if(c < LOW_CONFIDENCE).alias("needs_human_review"),
    )


def _weighted(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def _stat_columns() -> list:
    c, n = F.col("auto_confidence"), F.col("n")
    total = F.coalesce(F.sum(n), F.lit(0))
    reviewed, overrides = _weighted(F.col("is_human_reviewed")), _weighted(F.col("human_override"))

    def or_zero(value):
        return F.coalesce(round_exact(value, 4), F.lit(0.0))

    return [
        total.alias("total_records"),
        F.min("task").alias("task"),
        or_zero(F.sum(c * n) / F.sum(n)).alias("mean"),
        or_zero(F.min(c)).alias("min"),
        or_zero(F.max(c)).alias("max"),
        percent(_weighted(c == 0), total).alias("pct_zero"),
        reviewed.alias("reviewed_count"),
        overrides.alias("override_count"),
        percent(overrides, reviewed).alias("override_rate_pct"),
        _weighted((c > 0) & (c < LOW_CONFIDENCE)).alias("low_confidence_count"),
        _weighted(c == 0).alias("zero_signal_count"),
        _weighted(c < LOW_CONFIDENCE).alias("needs_human_review"),
    ]


def _with_median(stats: DataFrame, profile: DataFrame) -> DataFrame:
    """The exact median of all confidences as a scalar subquery: imported ones may be any number of values."""
    median = exact_median(profile, "auto_confidence", "n").scalar()
    return stats.withColumn("median", F.coalesce(round_exact(median, 4), F.lit(0.0)))


def annotation_summary(records: DataFrame) -> DataFrame:
    """The whole run in one nested row."""
    profile = stored(label_profile(records).fillna("", ["final_label", "auto_label"]), "profile")
    # Three groupings of the small profile in one job: totals, per final and per auto label.
    levels = profile.groupingSets(
        [[], [F.col("final_label")], [F.col("auto_label")]], F.col("final_label"), F.col("auto_label")
    ).agg(F.grouping_id().alias("level"), *_stat_columns())
    levels = _with_median(levels, profile)
    final_level, auto_level, total_level = 1, 2, 3
    at_total = F.col("level") == total_level

    def total(name: str, empty: float | None = 0):
        # An empty run has no row at any level.
        return F.coalesce(F.max(F.when(at_total, F.col(name))), F.lit(empty)).alias(name)

    def counts(level: int, label: str):
        entry = F.struct(label, "total_records")
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("level") == level, entry))))

    return levels.agg(
        F.current_timestamp().alias("generated_at"),
        F.lit(__version__).alias("pipeline_version"),
        total("total_records"),
        total("task", None),
        counts(final_level, "final_label").alias("label_distribution"),
        counts(auto_level, "auto_label").alias("auto_label_distribution"),
        F.struct(*[total(c) for c in ("mean", "median", "min", "max", "pct_zero")]).alias("confidence_stats"),
        F.struct(*[total(c) for c in ("reviewed_count", "override_count", "override_rate_pct")]).alias(
            "human_review"
        ),
        F.struct(
            *[total(c) for c in ("low_confidence_count", "zero_signal_count", "needs_human_review")]
        ).alias("quality_flags"),
    )

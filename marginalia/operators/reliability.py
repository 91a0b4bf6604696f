"""Documented reliability measures: Krippendorff's alpha, label drift, annotator scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent, ratio, round_exact
from marginalia.sources.paths import stored

# Documented gates and the length of a calibration set.
MIN_COMPLETION_PCT = 95
CALIBRATION_ITEMS = 10
MIN_CALIBRATION_PCT = 80


def krippendorff_alpha(ratings: DataFrame, item_col: str = "item", label_col: str = "label") -> DataFrame:
    """Nominal alpha for any number of annotators: n_items, n_values, alpha (4 decimals).

    ``ratings`` has one row per judgement. Items judged once cannot be paired and do not
    count. Counts per item and label replace pairs of judgements; each aggregate combines
    map-side, so a heavily judged item costs one row per label.
    """
    per_label = (
        ratings.select(F.col(item_col).alias("item"), F.col(label_col).alias("label"))
        .groupBy("item", "label")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # Per item: judgements m, and pairs that disagree, scaled by 1 / (m - 1).
    per_item = per_label.groupBy("item").agg(
        F.sum("n").alias("m"),
        F.sum(F.col("n") * F.col("n")).alias("same"),
        F.min("label").alias("label"),
    )
    m, zero = F.col("m"), F.lit(0.0)
    paired = F.when(m > 1, (m * m - F.col("same")) / (m - 1)).otherwise(zero)

    def part(label: Column, n: Column, d: Column, items: Column) -> list[Column]:
        return [label.alias("label"), n.alias("n"), d.alias("d"), items.alias("items")]

    # Label totals, less the labels of items judged once, plus what each item disagrees by.
    by_label = (
        per_label.select(*part(F.col("label"), F.col("n"), zero, F.lit(0)))
        .unionByName(
            per_item.select(
                *part(F.col("label"), F.when(m > 1, 0.0).otherwise(-1.0), paired, F.when(m > 1, 1).otherwise(0))
            )
        )
        .groupBy("label")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum("items").alias("items"))
    )
    total, observed = F.sum("n"), F.sum("d")
    expected = total * total - F.sum(F.col("n") * F.col("n"))
    alpha = F.when(expected > 0, 1 - (total - 1) * observed / expected).otherwise(1.0)
    return by_label.agg(
        F.coalesce(F.sum("items"), F.lit(0)).alias("n_items"),
        F.coalesce(total, F.lit(0.0)).cast("long").alias("n_values"),
        F.when(total > 0, round_exact(alpha, 4)).alias("alpha"),
    )


def label_drift(df: DataFrame, batch_col: str, label_col: str) -> DataFrame:
    """batch, n, drift: total variation distance of a batch's label shares from all rows'.

    Labels a batch never uses add their overall share, which is what the shares of the
    labels it does use leave over; so no batch-by-label grid is built.
    """
    counts = df.groupBy(F.col(batch_col).alias("batch"), F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Read for each kind of total, hence written once. Totals are joined, so no task sees all batches of a label.
    counts = stored(counts, "drift-counts")
    by_batch = counts.groupBy("batch").agg(F.sum("n").alias("batch_n")).withColumnRenamed("batch", "of_batch")
    by_label = counts.groupBy("label").agg(F.sum("n").alias("label_n")).withColumnRenamed("label", "of_label")
    every = counts.agg(F.sum("n")).scalar()
    counts = counts.join(by_batch, F.col("batch").eqNullSafe(F.col("of_batch"))).join(
        by_label, F.col("label").eqNullSafe(F.col("of_label"))
    )
    # Whole numbers up to the final division, so the result does not depend on the order of summing.
    whole = "decimal(18,0)"
    here, in_batch, of_label = (F.col(c).cast(whole) for c in ("n", "batch_n", "label_n"))
    total = every.cast(whole)
    expected = of_label * in_batch
    gaps = counts.select(
        "batch", "n", (F.abs(here * total - expected) - expected).alias("gap"), (in_batch * total).alias("scale")
    )
    distance = (F.sum("gap") + F.max("scale")).cast("double") / (2 * F.max("scale")).cast("double")
    return gaps.groupBy("batch").agg(F.sum("n").alias("n"), round_exact(distance, 4).alias("drift"))


def annotator_scorecard(
    records: DataFrame, gold: DataFrame, assigned: DataFrame, id_col: str = "source_id"
) -> DataFrame:
    """Per annotator and task: pace, completion and calibration against their gates.

    ``records`` are reviewed records, ``assigned`` has annotator, task and n_assigned,
    ``gold`` has one final_label per id. Calibration looks at each annotator's first ten
    gold items by time; the rank filter is pushed below the shuffle, so each map task
    sends at most ten rows per annotator.
    """
    keys = ["annotator", "task"]
    pace = records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_done"), F.sum("annotation_time_sec").alias("seconds")
    )
    truth = gold.select(id_col, F.col("final_label").alias("gold_label"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("created_at", id_col))
    calibration = (
        records.select(*keys, id_col, "created_at", "final_label")
        .join(truth, id_col)
        .withColumn("nth", first)
        .filter(F.col("nth") <= CALIBRATION_ITEMS)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_calibration"),
            F.count_if(F.col("final_label") == F.col("gold_label")).alias("n_matching"),
        )
    )
    completion = percent(F.col("n_done"), F.col("n_assigned"))
    agreement = percent(F.col("n_matching"), F.col("n_calibration"))
    return (
        pace.join(assigned, keys)
        .join(calibration, keys, "left")
        .select(
            *keys,
            "n_done",
            "n_assigned",
            round_exact(ratio(F.col("n_done") * 3600, F.col("seconds")), 1).alias("items_per_hour"),
            completion.alias("completion_pct"),
            (completion >= MIN_COMPLETION_PCT).alias("completion_ok"),
            F.coalesce("n_calibration", F.lit(0)).alias("n_calibration"),
            agreement.alias("calibration_pct"),
            (agreement >= MIN_CALIBRATION_PCT).alias("calibration_ok"),
        )
    )

"""How often, where and to what humans corrected the automatic label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.bands import OVERRIDE_BANDS, override_band
from marginalia.functions.numbers import coerce_bool, percent
from marginalia.operators.checks import Check

# Highest healthy override share in percent; labels listed per direction.
MAX_OVERRIDE_PCT = 25
SHOWN_LABELS = 5

# Column-name form of the confidence bands, in band order.
BAND_SLUGS = ["0_20", "20_40", "40_70", "70_up"]

NO_COLUMN = "No 'is_human_reviewed' column found."
NO_REVIEWS = "No human-reviewed items in dataset."


def reviewed_rows(df: DataFrame) -> DataFrame:
    """auto_label, final_label, auto_confidence, overridden for human-reviewed rows.

    Where the override flag is absent it follows from the labels.
    """
    if "human_override" in df.columns:
        overridden = coerce_bool(F.col("human_override"))
    else:
        overridden = ~F.col("final_label").eqNullSafe(F.col("auto_label"))
    return df.filter(coerce_bool(F.col("is_human_reviewed"))).select(
        "auto_label", "final_label", "auto_confidence", overridden.alias("overridden")
    )


def override_by_band(df: DataFrame) -> DataFrame:
    """band, reviewed, overrides, override_rate; bands without reviewed rows are left out."""
    return (
        reviewed_rows(df)
        .select(override_band(F.col("auto_confidence")).alias("band"), "overridden")
        .filter(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count(F.lit(1)).alias("reviewed"), F.count_if("overridden").alias("overrides"))
        .withColumn("override_rate", percent(F.col("overrides"), F.col("reviewed")))
    )


def override_from_to(df: DataFrame, shown: int = SHOWN_LABELS) -> DataFrame:
    """direction (from: automatic label, to: final label), label, count; top labels each."""
    overrides = reviewed_rows(df).filter("overridden")

    def top(direction: str, column: str) -> DataFrame:
        return (
            overrides.groupBy(F.col(column).alias("label"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "label")
            .limit(shown)
            .select(F.lit(direction).alias("direction"), "label", "count")
        )

    return top("from", "auto_label").unionByName(top("to", "final_label"))


def override_totals(df: DataFrame) -> DataFrame:
    """Reviewed and overridden rows per automatic label and band."""
    band = override_band(F.col("auto_confidence"))
    in_band = [(i, band == name) for i, (_, _, name) in enumerate(OVERRIDE_BANDS)]
    return reviewed_rows(df).groupBy("auto_label").agg(
        F.count(F.lit(1)).alias("reviewed"),
        F.count_if("overridden").alias("overrides"),
        *[F.count_if(hit).alias(f"reviewed_{i}") for i, hit in in_band],
        *[F.count_if(hit & F.col("overridden")).alias(f"overrides_{i}") for i, hit in in_band],
    )


def override_check() -> Check:
    """Over per-label override totals. Exactly the limit neither warns nor passes."""
    reviewed, overrides = F.col("human_reviewed"), F.col("overrides")
    rate = F.col("overall_override_rate_pct")
    summed = ["overrides", *[f"{w}_{i}" for w in ("reviewed", "overrides") for i in range(len(BAND_SLUGS))]]
    bands = {
        f"{what}_{slug}": F.when(F.col(f"reviewed_{i}") > 0, value)
        for i, slug in enumerate(BAND_SLUGS)
        for what, value in [
            ("reviewed", F.col(f"reviewed_{i}").cast("double")),
            ("overrides", F.col(f"overrides_{i}").cast("double")),
            ("override_rate", percent(F.col(f"overrides_{i}"), F.col(f"reviewed_{i}"))),
        ]
    }
    return Check(
        name="Override Analysis",
        totals={
            "human_reviewed": F.coalesce(F.sum("reviewed"), F.lit(0)),
            **{c: F.coalesce(F.sum(c), F.lit(0)) for c in summed},
            "worst_label": F.min_by("auto_label", F.struct(-F.col("overrides"), F.col("auto_label"))),
        },
        figures={
            "human_reviewed": reviewed,
            "overrides": overrides,
            "overall_override_rate_pct": percent(overrides, reviewed),
            **bands,
        },
        sections={name: "by_confidence_band" for name in bands},
        passed=rate < MAX_OVERRIDE_PCT,
        issues=[
            F.when(
                rate > MAX_OVERRIDE_PCT,
                F.concat(
                    F.lit("High override rate "),
                    rate.cast("string"),
                    F.lit("% — consider improving rules for '"),
                    F.col("worst_label"),
                    F.lit("'"),
                ),
            )
        ],
        reason=F.when(reviewed == 0, NO_REVIEWS),
    )


def skipped_override_check() -> Check:
    """Stand-in where the table has no review flag at all."""
    return Check(
        name="Override Analysis",
        totals={"human_reviewed": F.lit(0)},
        figures={},
        passed=F.lit(None).cast("boolean"),
        issues=[F.lit(None).cast("string")],
        reason=F.lit(NO_COLUMN),
    )


def check_override_analysis(df: DataFrame) -> DataFrame:
    """One row: reviewed and overridden rows, rate, rate per confidence band."""
    if "is_human_reviewed" not in df.columns:
        return skipped_override_check().flat(df.sparkSession.range(1))
    return override_check().run(override_totals(df))

"""Label distribution, imbalance and automatic/final agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent, ratio, round_exact
from marginalia.operators.checks import Check
from marginalia.operators.prefix import RANGE, with_totals_before

# A class this many times its even share dominates; Gini from here on fails.
DOMINANCE = 5
MAX_GINI = 0.6


def label_distribution(df: DataFrame, label_col: str = "final_label") -> DataFrame:
    """label, count, pct (2 decimals), most frequent first."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    # Windows here run over one row per label.
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("count"), total)).orderBy(F.desc("count"), "label")


def _classes(df: DataFrame, label_col: str, auto_col: str | None) -> DataFrame:
    """label, n, agree per class, with the number of rows and classes and the sum of rank times n.

    Ranks go by rising n. Classes of equal n follow each other, so all of a size add up in closed form,
    given how many classes are smaller; no class is ranked by itself.
    """
    agree = F.count_if(F.col(auto_col) == F.col(label_col)) if auto_col else F.lit(None).cast("long")
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"), agree.alias("agree"))
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    # Some thousand ranges at most: 64 for each doubling of n.
    ranged = sizes.withColumn(RANGE, F.floor(F.log2("n") * 64))
    placed = with_totals_before(ranged, ["n"], "m", "smaller")
    m, smaller = F.col("m").cast("decimal(19,0)"), F.col("smaller")
    ranks = m * smaller.cast("decimal(19,0)") + F.expr("cast(m as decimal(19,0)) * (cast(m as decimal(19,0)) + 1) div 2")
    ranked = placed.agg(F.sum(F.col("n") * ranks.cast("double")).alias("ranked")).scalar()
    whole = counts.agg(F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k")).alias("whole")).scalar()
    return counts.select(
        "label", "n", "agree", whole["total"].alias("total"), whole["k"].alias("k"), ranked.alias("ranked")
    )


def distribution_check() -> Check:
    """Over classes: class count, Gini, agreement, dominant classes."""
    n, total, k = F.col("n"), F.col("total"), F.col("k")
    share_pct = ratio(n, total) * 100
    even = 1 / k
    warning = F.format_string(
        "'%s' is heavily dominant (%.1f%% vs expected %.1f%%)",
        F.col("label"),
        round_exact(share_pct, 1),
        round_exact(even * 100, 1),
    )
    dominant = share_pct > even * (100 * DOMINANCE)
    classes, gini, flags = F.col("n_classes"), F.col("gini"), F.col("flags")
    agreement = F.when(F.col("agreeing").isNotNull(), percent(F.col("agreeing"), F.col("n_rows")))
    return Check(
        name="Label Distribution",
        totals={
            "n_rows": F.coalesce(F.sum("n"), F.lit(0)),
            "n_classes": F.count(F.lit(1)),
            "agreeing": F.sum("agree"),
            # (2 * sum(rank * share) - (k + 1)) / k over ascending shares; 0 for one class.
            "gini": F.coalesce(
                F.when(
                    F.max("k") > 1,
                    (2 * F.max("ranked") / F.max("total") - (F.max("k") + 1)) / F.max("k"),
                ),
                F.lit(0.0),
            ),
            "flags": F.sort_array(F.collect_list(F.when(dominant, F.struct((-n).alias("o"), warning.alias("m"))))),
        },
        figures={
            "n_classes": classes,
            "gini_coefficient": round_exact(gini, 4),
            "auto_final_agreement_pct": agreement,
            "imbalance_flags": F.size(flags).cast("long"),
        },
        passed=(F.size(flags) == 0) & (gini < MAX_GINI),
        issues=flags["m"],
    )


def distribution_totals(
    df: DataFrame, label_col: str = "final_label", auto_col: str = "auto_label"
) -> DataFrame:
    classes = _classes(df, label_col, auto_col if auto_col in df.columns else None)
    return classes.agg(*distribution_check().total_columns())


def check_label_distribution(
    df: DataFrame, label_col: str = "final_label", auto_col: str = "auto_label"
) -> DataFrame:
    """One row: classes, Gini, agreement with the automatic label, dominance warnings."""
    return distribution_check().flat(distribution_totals(df, label_col, auto_col))

"""Accuracy, precision, recall and F1 of automatic labels against gold labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent, ratio, round_exact
from marginalia.operators.agreement import margins, paired_counts
from marginalia.operators.checks import Check

# Fixed value: lowest acceptable accuracy in percent.
MIN_ACCURACY_PCT = 70


def gold_counts(df: DataFrame, gold: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Pair counts: label_a is the automatic label, label_b the gold one."""
    return paired_counts(df, gold, id_col, "auto_label", "final_label")


def per_label_scores(counts: DataFrame, summed: bool = False) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1 (4 decimals), support, over all labels seen.

    ``summed`` adds the running sum of F1 the check averages.
    """
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.col("exact_precision"), F.col("exact_recall")
    # One row per label; F1 summed in label order, so its last digits are settled.
    in_order = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
    scores = (
        margins(counts)
        .select(
            "label",
            F.col("n_both").alias("tp"),
            (F.col("n_a") - F.col("n_both")).alias("fp"),
            (F.col("n_b") - F.col("n_both")).alias("fn"),
        )
        .select("*", ratio(tp, tp + fp).alias("exact_precision"), ratio(tp, tp + fn).alias("exact_recall"))
        .select(
            "label",
            "tp",
            "fp",
            "fn",
            round_exact(precision, 4).alias("precision"),
            round_exact(recall, 4).alias("recall"),
            round_exact(ratio(2 * precision * recall, precision + recall), 4).alias("f1"),
            (tp + fn).alias("support"),
        )
    )
    return scores.withColumn("f1_sum", F.sum("f1").over(in_order)) if summed else scores


def golden_check() -> Check:
    """Over per-label scores; macro-F1 averages the rounded F1 values."""
    n, correct = F.col("n_validated"), F.col("correct")
    accuracy = F.col("accuracy_pct")
    return Check(
        name="Golden Set Validation",
        totals={
            "n_validated": F.coalesce(F.sum("support"), F.lit(0)),
            "correct": F.coalesce(F.sum("tp"), F.lit(0)),
            "mean_f1": F.max("f1_sum") / F.count("f1"),
        },
        figures={
            "n_validated": n,
            "accuracy_pct": percent(correct, n),
            "macro_f1": round_exact(F.col("mean_f1"), 4),
        },
        passed=accuracy >= MIN_ACCURACY_PCT,
        issues=[
            F.when(
                (n > 0) & (accuracy < MIN_ACCURACY_PCT),
                F.concat(
                    F.lit("Accuracy "), accuracy.cast("string"), F.lit(f"% below {MIN_ACCURACY_PCT}% target")
                ),
            )
        ],
        reason=F.when(n == 0, "No matching IDs found."),
    )


def check_golden_set(df: DataFrame, gold: DataFrame, id_col: str = "source_id") -> DataFrame:
    """One row: validated items, accuracy, macro-F1; skipped without matching ids."""
    return golden_check().run(per_label_scores(gold_counts(df, gold, id_col), summed=True))

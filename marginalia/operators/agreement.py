"""Agreement between two annotators: joins, confusion counts, Cohen's kappa.

Everything follows from one small table of label pairs with counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.bands import interpret_kappa
from marginalia.functions.numbers import percent, round_exact
from marginalia.operators.checks import Check

# Lowest acceptable kappa; how many conflicting label pairs are reported.
MIN_KAPPA = 0.60
SHOWN_CONFLICTS = 5


def join_annotators(a: DataFrame, b: DataFrame, id_col: str = "source_id") -> DataFrame:
    """id, final_label_a, final_label_b for every shared id; repeated ids multiply."""
    left = a.select(id_col, F.col("final_label").alias("final_label_a"))
    right = b.select(id_col, F.col("final_label").alias("final_label_b"))
    return left.join(right, id_col)


def join_gold(df: DataFrame, gold: DataFrame, id_col: str = "source_id") -> DataFrame:
    """id, auto_label, auto_confidence, golden_label for every id found in the gold table."""
    truth = gold.select(id_col, F.col("final_label").alias("golden_label"))
    return df.select(id_col, "auto_label", "auto_confidence").join(truth, id_col)


def paired_counts(
    a: DataFrame, b: DataFrame, id_col: str, label_a: str = "final_label", label_b: str = "final_label"
) -> DataFrame:
    """label_a, label_b, n over the many-to-many join, without producing its rows.

    One side is first reduced to counts per id and label. A row of the other side then
    meets at most one row per distinct label, so an id held by a third of both tables
    costs linear, not quadratic, work; a hot id of the large side is split by the
    adaptive skew join, or not shuffled at all where the reduced side is small enough
    for the planner to broadcast.
    """
    left = a.select(F.col(id_col).alias("id"), _named(label_a).alias("label_a"))
    right = (
        b.select(F.col(id_col).alias("id"), _named(label_b).alias("label_b"))
        .groupBy("id", "label_b")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return left.join(right, "id").groupBy("label_a", "label_b").agg(F.sum("times").alias("n"))


def confusion_counts(df: DataFrame, label_a: str, label_b: str, by: Sequence[str] = ()) -> DataFrame:
    """label_a, label_b, n for two label columns of one table."""
    return (
        df.select(*by, _named(label_a).alias("label_a"), _named(label_b).alias("label_b"))
        .groupBy(*by, "label_a", "label_b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _named(label: str) -> Column:
    return F.coalesce(F.col(label), F.lit(""))


def confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Pair counts as a square: one row per label_a, one column per label of ``labels``."""
    return (
        counts.groupBy("label_a").pivot("label_b", list(labels)).agg(F.sum("n")).fillna(0)
    )


def label_union(df: DataFrame, label_a: str, label_b: str) -> DataFrame:
    """Distinct labels of two columns."""
    return df.select(F.explode(F.array(label_a, label_b)).alias("label")).distinct()


def margins(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label: n_a and n_b (how often each side used it) and n_both (on the same item)."""
    a, b, n = F.col("label_a"), F.col("label_b"), F.col("n")
    zero = F.lit(0).cast("long")

    def side(label: Column, n_a: Column, n_b: Column, n_both: Column) -> Column:
        return F.struct(label.alias("label"), n_a.alias("n_a"), n_b.alias("n_b"), n_both.alias("n_both"))

    both = F.when(a == b, n).otherwise(zero)
    return (
        counts.select(*by, F.inline(F.array(side(a, n, zero, both), side(b, zero, n, zero))))
        .groupBy(*by, "label")
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("n_both").alias("n_both"))
    )


def _kappa(n: Column, agreeing: Column, chance: Column) -> Column:
    total = n.cast("double")
    expected = chance / (total * total)
    kappa = F.when(1 - expected > 0, (agreeing / total - expected) / (1 - expected)).otherwise(1.0)
    return F.when(n == 0, 0.0).otherwise(round_exact(kappa, 4))


def agreement_totals() -> dict[str, Column]:
    """Aggregates over ``margins`` rows."""
    return {
        "shared_items": F.coalesce(F.sum("n_a"), F.lit(0)),
        "agreeing": F.coalesce(F.sum("n_both"), F.lit(0)),
        "chance": F.coalesce(F.sum(F.col("n_a").cast("double") * F.col("n_b").cast("double")), F.lit(0.0)),
    }


def cohens_kappa(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """kappa (4 decimals) and n from label pair counts; one row, or one per ``by`` group."""
    totals = [c.alias(n) for n, c in agreement_totals().items()]
    return margins(counts, by).groupBy(*by).agg(*totals).select(
        *by,
        F.col("shared_items").alias("n"),
        _kappa(F.col("shared_items"), F.col("agreeing"), F.col("chance")).alias("kappa"),
    )


def agreement_check() -> Check:
    n, agreeing = F.col("shared_items"), F.col("agreeing")
    kappa = F.col("cohens_kappa")
    return Check(
        name="Inter-Annotator Agreement",
        totals=agreement_totals(),
        figures={
            "shared_items": n,
            "exact_agreement_pct": percent(agreeing, n),
            "cohens_kappa": _kappa(n, agreeing, F.col("chance")),
            "disagreement_count": n - agreeing,
        },
        passed=kappa >= MIN_KAPPA,
        issues=[
            F.when(
                (n > 0) & (kappa < MIN_KAPPA),
                F.format_string(
                    f"Kappa=%.3f (%s) — target ≥ {MIN_KAPPA:.2f}", round_exact(kappa, 3), interpret_kappa(kappa)
                ),
            )
        ],
        reason=F.when(n == 0, "No shared IDs found."),
    )


def check_inter_annotator(a: DataFrame, b: DataFrame, id_col: str = "source_id") -> DataFrame:
    """One row: shared items, agreement, kappa with its reading; skipped without shared ids."""
    checked = agreement_check().run(margins(paired_counts(a, b, id_col)))
    return checked.withColumn("kappa_interpretation", interpret_kappa(F.col("cohens_kappa")))


def top_conflicts(counts: DataFrame, shown: int = SHOWN_CONFLICTS) -> DataFrame:
    """Most frequent disagreeing label pairs."""
    return (
        counts.filter(F.col("label_a") != F.col("label_b"))
        .select(
            F.col("label_a").alias("final_label_a"),
            F.col("label_b").alias("final_label_b"),
            F.col("n").alias("count"),
        )
        .orderBy(F.desc("count"), "final_label_a", "final_label_b")
        .limit(shown)
    )

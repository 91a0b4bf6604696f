"""All checks over one labelled table, their verdict and report rows.

Give these functions a stored table (what ``label_job.label_file`` wrote): every branch
reads only the columns it needs from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators import agreement, distribution, duplicates, golden, overrides, rowchecks
from marginalia.operators.checks import RESULT_FIELDS, results
from marginalia.operators.summary import label_shares

# Fixed value: order in which checks are reported.
CHECK_ORDER = [
    "Completeness",
    "Confidence Analysis",
    "Label Distribution",
    "Duplicate Detection",
    "Text Quality",
    "Override Analysis",
    "Golden Set Validation",
    "Inter-Annotator Agreement",
]


def run_checks(
    df: DataFrame,
    threshold: float = rowchecks.LOW,
    gold: DataFrame | None = None,
    other: DataFrame | None = None,
    id_col: str = "source_id",
) -> DataFrame:
    """One row per check: ord, check, passed, skipped, reason, issues, metrics.

    The three row-level checks share one pass. Distribution, duplicates, overrides and
    the two joins each need their own grouping. Gold and agreement run where given.
    """
    rowwise = [
        rowchecks.completeness_check(),
        rowchecks.confidence_check(threshold),
        rowchecks.text_quality_check(),
    ]
    totals = df.agg(*[c for check in rowwise for c in check.total_columns()])
    parts = [
        results(rowchecks.with_confidence_median(totals, df), *rowwise),
        results(distribution.distribution_totals(df), distribution.distribution_check()),
        _grouped(duplicates.duplicate_groups(df), duplicates.duplicate_check()),
    ]
    if "is_human_reviewed" in df.columns:
        parts.append(_grouped(overrides.override_totals(df), overrides.override_check()))
    else:
        parts.append(results(df.sparkSession.range(1), overrides.skipped_override_check()))
    if gold is not None:
        scores = golden.per_label_scores(golden.gold_counts(df, gold, id_col), summed=True)
        parts.append(_grouped(scores, golden.golden_check()))
    if other is not None:
        pairs = agreement.paired_counts(df, other, id_col)
        parts.append(_grouped(agreement.margins(pairs), agreement.agreement_check()))
    position = F.array_position(F.array(*[F.lit(c) for c in CHECK_ORDER]), F.col("check"))
    return reduce(DataFrame.unionByName, parts).select(
        position.cast("int").alias("ord"), *RESULT_FIELDS
    )


def _grouped(groups: DataFrame, check) -> DataFrame:
    return results(groups.agg(*check.total_columns()), check)


def overall_verdict(checks: DataFrame) -> DataFrame:
    """One row: status (FAIL as soon as one check failed), and checks passed, failed, skipped."""
    failed = F.count_if(~F.col("passed"))
    return checks.agg(
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        F.count_if("passed").alias("n_pass"),
        failed.alias("n_fail"),
        F.count_if(F.col("passed").isNull()).alias("n_skip"),
    )


def check_metrics(checks: DataFrame) -> DataFrame:
    """Long form of the metrics of result rows: check, section, metric, value."""
    return (
        checks.select("check", F.inline("metrics"))
        .filter(F.col("value").isNotNull())
        .select("check", "section", "metric", "value")
    )


def label_metrics(
    df: DataFrame, gold: DataFrame | None = None, other: DataFrame | None = None, id_col: str = "source_id"
) -> DataFrame:
    """Long form of everything reported per label: check, section, key, metric, value."""

    def melt(table: DataFrame, check: str, section: str, key, *metrics: str) -> DataFrame:
        rows = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        return table.select(
            F.lit(check).alias("check"), F.lit(section).alias("section"), key.alias("key"), F.inline(rows)
        )

    parts = [
        melt(
            distribution.label_distribution(df), "Label Distribution", "distribution", F.col("label"), "count", "pct"
        )
    ]
    if "is_human_reviewed" in df.columns:
        directions = overrides.override_from_to(df)
        key = F.concat_ws(": ", "direction", "label")
        parts.append(melt(directions, "Override Analysis", "from_to", key, "count"))
    if gold is not None:
        scores = golden.per_label_scores(golden.gold_counts(df, gold, id_col))
        parts.append(
            melt(
                scores,
                "Golden Set Validation",
                "per_label",
                F.col("label"),
                "precision",
                "recall",
                "f1",
                "support",
            )
        )
    if other is not None:
        conflicts = agreement.top_conflicts(agreement.paired_counts(df, other, id_col))
        key = F.concat_ws(" / ", "final_label_a", "final_label_b")
        parts.append(melt(conflicts, "Inter-Annotator Agreement", "top_conflicts", key, "count"))
    return reduce(DataFrame.unionByName, parts)


def report_rows(
    df: DataFrame,
    checks: DataFrame,
    gold: DataFrame | None = None,
    other: DataFrame | None = None,
    id_col: str = "source_id",
) -> DataFrame:
    """Everything a report shows, as rows: section, item, metric, text, value.

    Sections: overall (status and counts), labels (shares), checks (verdict and issues
    per check), figures (metrics per check), and per-label details.
    """
    none = F.lit(None)
    verdict = F.when(F.col("passed"), "PASS").when(~F.col("passed"), "FAIL").otherwise("SKIP")

    def row(section: str, item, metric, text, value):
        return [
            F.lit(section).alias("section"),
            item.cast("string").alias("item"),
            metric.cast("string").alias("metric"),
            text.cast("string").alias("text"),
            value.cast("double").alias("value"),
        ]

    overall = overall_verdict(checks).select(
        F.inline(
            F.array(
                F.struct(*row("overall", F.lit("status"), F.lit("status"), F.col("status"), none)),
                *[
                    F.struct(*row("overall", F.lit("checks"), F.lit(c), none, F.col(c)))
                    for c in ("n_pass", "n_fail", "n_skip")
                ],
            )
        )
    )
    shares = label_shares(df).select(
        F.inline(
            F.array(
                F.struct(*row("labels", F.col("label"), F.lit("count"), none, F.col("count"))),
                F.struct(*row("labels", F.col("label"), F.lit("pct"), none, F.col("pct"))),
            )
        )
    )
    verdicts = checks.select(*row("checks", F.col("check"), F.lit("verdict"), verdict, none))
    lines = checks.select("check", F.explode("issues").alias("line")).select(
        *row("checks", F.col("check"), F.lit("issue"), F.col("line"), none)
    )
    reasons = checks.filter("skipped").select(
        *row("checks", F.col("check"), F.lit("reason"), F.col("reason"), none)
    )
    figures = check_metrics(checks).select(
        *row("figures", F.col("check"), F.col("metric"), F.col("section"), F.col("value"))
    )
    details = label_metrics(df, gold, other, id_col).select(
        *row("details", F.concat_ws(": ", "check", "key"), F.col("metric"), F.col("section"), F.col("value"))
    )
    return reduce(DataFrame.unionByName, [overall, shares, verdicts, lines, reasons, figures, details])

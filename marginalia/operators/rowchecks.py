"""Checks that need nothing but each row: completeness, confidence, text quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions import text as t
from marginalia.functions.numbers import percent, ratio, round_exact, thousands
from marginalia.operators.checks import Check, when_any
from marginalia.operators.median import exact_median

# Label spellings that mean "missing".
MISSING_LABELS = ["", "nan", "None", "null"]
# Confidence bucket edges and the gate on the share needing review.
LOW, MEDIUM, HIGH = 0.20, 0.40, 0.70
MAX_REVIEW_PCT = 30
# Shortest and longest acceptable text.
MIN_CHARS, MAX_CHARS = 5, 5000


def _missing(label: str):
    return F.coalesce(F.col(label), F.lit("")).isin(*MISSING_LABELS)


def completeness_check() -> Check:
    """Missing labels and blank texts fail; missing confidence or auto label is only noted."""
    confidence = F.col("auto_confidence")
    total, labels, texts = F.col("total_records"), F.col("missing_labels"), F.col("empty_text")
    complete = F.when(total == 0, 0.0).otherwise(round_exact((1 - ratio(labels + texts, total)) * 100, 2))
    return Check(
        name="Completeness",
        totals={
            "total_records": F.count(F.lit(1)),
            "missing_labels": F.count_if(_missing("final_label")),
            "empty_text": F.count_if(t.is_blank(F.col("text"))),
            "missing_confidence": F.count_if(confidence.isNull() | F.isnan(confidence)),
            "missing_auto_labels": F.count_if(_missing("auto_label")),
        },
        figures={
            "total_records": total,
            "missing_labels": labels,
            "empty_text": texts,
            "missing_confidence": F.col("missing_confidence"),
            "missing_auto_labels": F.col("missing_auto_labels"),
            "completeness_pct": complete,
        },
        sections={
            n: "flags" for n in ("missing_labels", "empty_text", "missing_confidence", "missing_auto_labels")
        },
        passed=(labels == 0) & (texts == 0),
        issues=[
            when_any(F.col(n), thousands(F.col(n)), message)
            for n, message in [
                ("missing_labels", " records have no final_label"),
                ("empty_text", " records have empty text"),
                ("missing_confidence", " records missing confidence score"),
                ("missing_auto_labels", " records have no auto_label"),
            ]
        ],
    )


def check_completeness(df: DataFrame) -> DataFrame:
    return completeness_check().run(df)


def confidence_check(threshold: float = LOW) -> Check:
    """Confidence spread, buckets and share below ``threshold``.

    Only "very low" follows the threshold; the other bucket edges are fixed, so buckets
    overlap above 0.20 and leave a gap below it. Expects a ``median`` next to the totals
    (see ``confidence_totals``).
    """
    raw = F.col("auto_confidence")
    valid = F.when(~F.isnan(raw), raw)
    n, review = F.col("n_confidences"), F.col("needs_review_count")

    def stat(name: str):
        return F.when(n == 0, 0.0).otherwise(round_exact(F.col(name), 4))

    stats = ["mean", "median", "std", "min", "max"]
    buckets = ["zero", "very_low", "low", "medium", "high"]
    return Check(
        name="Confidence Analysis",
        totals={
            "n_confidences": F.count(valid),
            "mean": F.avg(valid),
            "std": F.stddev_samp(valid),
            "min": F.min(valid),
            "max": F.max(valid),
            "zero": F.count_if(valid == 0),
            "very_low": F.count_if((valid > 0) & (valid < threshold)),
            "low": F.count_if((valid >= LOW) & (valid < MEDIUM)),
            "medium": F.count_if((valid >= MEDIUM) & (valid < HIGH)),
            "high": F.count_if(valid >= HIGH),
            "needs_review_count": F.count_if(valid < threshold),
        },
        figures={
            "threshold": F.lit(float(threshold)),
            **{s: stat(s) for s in stats},
            **{b: F.col(b) for b in buckets},
            "needs_review_count": review,
            "needs_review_pct": percent(review, n),
        },
        sections={b: "buckets" for b in buckets},
        passed=F.col("needs_review_pct") < MAX_REVIEW_PCT,
        issues=[
            when_any(
                review,
                thousands(review),
                " items (",
                F.col("needs_review_pct").cast("string"),
                f"%) below confidence threshold {threshold:.0%}",
            )
        ],
    )


def with_confidence_median(totals: DataFrame, df: DataFrame) -> DataFrame:
    """Put the exact median next to the other totals, as a scalar subquery."""
    return totals.withColumn("median", exact_median(df, "auto_confidence").scalar())


def check_confidence(df: DataFrame, threshold: float = LOW) -> DataFrame:
    check = confidence_check(threshold)
    return check.flat(with_confidence_median(df.agg(*check.total_columns()), df))


def text_quality_check() -> Check:
    """Length extremes and broken encoding fail; shouting and !!! runs are only noted."""
    text = F.col("text")
    length = t.text_length(text)
    n = F.col("n_texts")
    short, long, broken = F.col("too_short"), F.col("too_long"), F.col("encoding_issues")
    flags = ["too_short", "too_long", "encoding_issues", "all_caps", "excess_punctuation"]
    return Check(
        name="Text Quality",
        totals={
            "n_texts": F.count(text),
            "mean_length": F.avg(length),
            # The state holds distinct lengths only: at most as many as the longest text has
            # characters, however many rows there are.
            "median_length": F.median(length),
            "min_length": F.min(length),
            "max_length": F.max(length),
            "too_short": F.count_if(length < MIN_CHARS),
            "too_long": F.count_if(length > MAX_CHARS),
            "encoding_issues": F.count_if(t.has_replacement_char(text)),
            "all_caps": F.count_if(t.is_shouting(text)),
            "excess_punctuation": F.count_if(t.has_excess_punctuation(text)),
        },
        figures={
            "mean_length": round_exact(F.col("mean_length"), 1),
            "median_length": round_exact(F.col("median_length"), 1),
            "min_length": F.col("min_length"),
            "max_length": F.col("max_length"),
            **{f: F.col(f) for f in flags},
        },
        sections={f: "flags" for f in flags},
        passed=(short == 0) & (long == 0) & (broken == 0),
        issues=[
            when_any(short, thousands(short), f" texts under {MIN_CHARS} characters"),
            when_any(long, thousands(long), f" texts over {MAX_CHARS:,} characters"),
            when_any(broken, thousands(broken), " texts with encoding issues (U+FFFD)"),
        ],
        reason=F.when(n == 0, "No texts to check."),
    )


def check_text_quality(df: DataFrame) -> DataFrame:
    return text_quality_check().run(df)

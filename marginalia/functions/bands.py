"""Named bands over kappa and confidence values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (exclusive upper bound, name), lowest band first; last one is open.
KAPPA_BANDS = [
    (0.0, "Poor (worse than chance)"),
    (0.20, "Slight"),
    (0.40, "Fair"),
    (0.60, "Moderate"),
    (0.80, "Substantial"),
    (None, "Almost Perfect"),
]

# Fixed values: [low, high) confidence bands of the override analysis.
OVERRIDE_BANDS = [
    (0.0, 0.2, "0%–20%"),
    (0.2, 0.4, "20%–40%"),
    (0.4, 0.7, "40%–70%"),
    (0.7, 1.01, "≥70%"),
]

# Documented review tiers by confidence (upper bound exclusive, zero apart).
REVIEW_TIERS = [
    (0.2, "1–20%", "review recommended"),
    (0.5, "20–50%", "review if time allows"),
    (0.8, "50–80%", "accept or spot-check"),
    (None, "80–100%", "accept"),
]
ZERO_TIER = ("0%", "always review")


def _ladder(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    rungs = F.lit(steps[-1][1])
    for bound, name in reversed(steps[:-1]):
        rungs = F.when(value < bound, name).otherwise(rungs)
    return F.when(value.isNotNull(), rungs)


def interpret_kappa(kappa: Column) -> Column:
    return _ladder(kappa, KAPPA_BANDS)


def override_band(confidence: Column) -> Column:
    """Band name, NULL outside every band."""
    return F.coalesce(
        *[F.when((confidence >= lo) & (confidence < hi), name) for lo, hi, name in OVERRIDE_BANDS]
    )


def review_tier(confidence: Column) -> Column:
    return F.when(confidence == 0, ZERO_TIER[0]).otherwise(
        _ladder(confidence, [(bound, name) for bound, name, _ in REVIEW_TIERS])
    )


def review_action(confidence: Column) -> Column:
    return F.when(confidence == 0, ZERO_TIER[1]).otherwise(
        _ladder(confidence, [(bound, action) for bound, _, action in REVIEW_TIERS])
    )

"""Numeric coercion, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def round_exact(value: Column, digits: int) -> Column:
    """Round the *binary* value of a double half-to-even, as Python's ``round`` does.

    ``F.round`` and ``F.bround`` round the shortest decimal text of the double, so
    2.675 becomes 2.68 although the stored number is below the tie. Here, where
    ``value * 10**digits`` lands on a tie, the part lost to its double rounding is
    recovered exactly (the value split at float precision keeps both partial products
    exact) and nudges the tie to its true side. Plain arithmetic inside codegen.
    """
    scale = float(10**digits)
    x = value.cast("double")
    scaled = x * scale
    high = x.cast("float").cast("double")
    lost = (high * scale - scaled) + (x - high) * scale
    nudge = F.when(F.abs(scaled % 1) == 0.5, F.signum(lost) * 0.25).otherwise(0.0)
    return F.rint(scaled + nudge) / scale


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_exact(ratio(part, whole) * 100, digits)


def coerce_confidence(text: Column) -> Column:
    """Numeric text to double; anything else, NaN included, becomes 0."""
    trimmed = F.trim(text)
    # A bare cast would also take Java spellings such as "1.0d" or "0x1p3".
    number = F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))


def coerce_bool(text: Column) -> Column:
    """True for the spellings True, true and 1; everything else, null included, is False."""
    return F.coalesce(text.cast("string").isin("True", "true", "1"), F.lit(False))


def thousands(count: Column) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(count.cast("long"), 0)

"""Exact median of a column with any number of distinct values, by selection in rounds.

The 64 bits of a double, read as an integer (mirrored for negatives), are in the order of the values. Round
by round the next 16 bits of the median are found: values that share the bits known so far are
counted by the next ones, and the running count tells which bits hold the middle. A round ranks
at most 65,536 counts, however many values there are and however close they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

_STEP = 16
_MANTISSA = 1 << 52


def _two_to(power: Column) -> Column:
    return F.pow(F.lit(2.0), power)


def ordered_bits(value: Column) -> Column:
    """A long that rises with a double that is neither NULL nor NaN; both zeros give 0."""
    size = F.abs(value)
    infinite = size == F.lit(float("inf"))
    finite = F.when(infinite | (size == 0), F.lit(1.0)).otherwise(size)
    # The logarithm may be off by one near powers of two; dividing by a power of two is exact.
    guess = F.greatest(F.least(F.floor(F.log2(finite)), F.lit(1023)), F.lit(-1022))
    part = finite / _two_to(guess)
    power = F.when(part >= 2, guess + 1).when((part < 1) & (guess > -1022), guess - 1).otherwise(guess)
    bits = (power + 1022) * _MANTISSA + (finite / _two_to(power) * float(_MANTISSA)).cast("long")
    bits = F.when(size == 0, F.lit(0).cast("long")).when(infinite, F.lit(2047 * _MANTISSA)).otherwise(bits)
    return F.when(value < 0, -bits).otherwise(bits)


def from_bits(bits: Column) -> Column:
    """The double whose ``ordered_bits`` these are."""
    size = F.abs(bits)
    power, mantissa = F.floor(size / F.lit(_MANTISSA).cast("decimal(20,0)")).cast("long"), size.bitwiseAND(_MANTISSA - 1)
    small = mantissa.cast("double") * F.lit(2.0**-537) * F.lit(2.0**-537)
    normal = (mantissa + _MANTISSA).cast("double") * _two_to(power - 1075)
    found = F.when(power == 0, small).when(power == 2047, F.lit(float("inf"))).otherwise(normal)
    return F.when(bits < 0, -found).otherwise(found)


def exact_median(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """One row, one column ``median``; NULL and NaN are left out.

    With ``weight``, a row counts as often as that column says.
    """
    value = F.col(column).cast("double")
    rows = df.select(value.alias("v"), (F.col(weight) if weight else F.lit(1)).alias("w"))
    counts = rows.filter(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("v").agg(F.sum("w").alias("n"))
    # Read by every round, hence written once.
    counts = stored(counts.select(ordered_bits(F.col("v")).alias("bits"), "n"), "median-counts")
    total = F.sum("n")
    # 1-based ranks of the two middle values; equal when the total is odd.
    ranks = F.array(F.floor((total + 1) / 2), F.floor(total / 2) + 1)
    wanted = counts.agg(F.posexplode(ranks).alias("which", "rank")).withColumn("known", F.lit(None).cast("long"))
    for round_ in range(1, 64 // _STEP + 1):
        left = 64 - _STEP * round_
        upper = F.shiftright("bits", left) if left else F.col("bits")
        known = F.shiftright("bits", left + _STEP) if round_ > 1 else F.lit(None).cast("long")
        narrowed = counts.select(upper.alias("upper"), known.alias("known"), "n")
        # Two rows at most are broadcast.
        narrowed = narrowed.join(F.broadcast(wanted), narrowed["known"].eqNullSafe(wanted["known"]))
        buckets = narrowed.groupBy("which", "rank", "upper").agg(F.sum("n").alias("n"))
        in_order = Window.partitionBy("which").orderBy("upper").rowsBetween(Window.unboundedPreceding, 0)
        upto = buckets.withColumn("upto", F.sum("n").over(in_order))
        wanted = upto.filter("upto >= rank AND upto - n < rank").select(
            "which", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("upper").alias("known")
        )
    middle = from_bits(F.col("known"))
    return wanted.agg(
        ((F.max(F.when(F.col("which") == 0, middle)) + F.max(F.when(F.col("which") == 1, middle))) / 2).alias("median")
    )

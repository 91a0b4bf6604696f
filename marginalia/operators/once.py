"""Compute costly columns exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: Sequence[Column | str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus ``columns``, as a one-row generator instead of a plain projection.

    The optimizer copies projected expressions into every filter, inferred null check or
    later column that mentions them, and a costly one would run once per copy. It does
    not look through a generator, and this one stays inside generated code.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))

"""Common shape of a quality check.

A check that looks at rows is a set of aggregates plus expressions over their results.
Keeping both apart lets several checks share one pass over the table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One row per check; ``passed`` is NULL where the check was skipped.
RESULT_FIELDS = ["check", "passed", "skipped", "reason", "issues", "metrics"]


@dataclass(frozen=True)
class Check:
    """``totals`` are aggregates over rows; ``figures`` are written over totals; the
    verdict and issue lines over figures and totals (a figure hides a total of its name)."""

    name: str
    totals: dict[str, Column]
    figures: dict[str, Column]
    passed: Column
    issues: list[Column] | Column  # optional lines, or one array of lines
    reason: Column = field(default_factory=lambda: F.lit(None).cast("string"))
    sections: dict[str, str] = field(default_factory=dict)  # figure -> section, "stats" otherwise

    def flat(self, totals: DataFrame) -> DataFrame:
        """One typed row: check, figures, passed, skipped, reason, issues."""
        return with_figures(totals, self).select(
            F.lit(self.name).alias("check"), *self.figures, *self._verdict()
        )

    def run(self, df: DataFrame) -> DataFrame:
        return self.flat(df.agg(*self.total_columns()))

    def total_columns(self) -> list[Column]:
        return [c.alias(n) for n, c in self.totals.items()]

    def result(self) -> Column:
        """The same row as a struct of RESULT_FIELDS, figures folded into long metrics."""
        rows = ", ".join(
            f"struct('{self.sections.get(name, 'stats')}', '{name}', cast({name} as double))"
            for name in self.figures
        )
        shape = "array<struct<section:string,metric:string,value:double>>"
        metrics = F.expr(f"cast(array({rows}) as {shape})")
        return F.struct(F.lit(self.name).alias("check"), *self._verdict(), metrics.alias("metrics"))

    def _verdict(self) -> list[Column]:
        skipped = self.reason.isNotNull()
        lines = F.array_compact(F.array(*self.issues)) if isinstance(self.issues, list) else self.issues
        return [
            F.when(~skipped, self.passed).alias("passed"),
            skipped.alias("skipped"),
            self.reason.alias("reason"),
            lines.alias("issues"),
        ]


def with_figures(totals: DataFrame, *checks: Check) -> DataFrame:
    """Name every figure once, so verdicts and messages only refer to columns."""
    return totals.withColumns({n: c for check in checks for n, c in check.figures.items()})


def results(totals: DataFrame, *checks: Check) -> DataFrame:
    """Result rows of several checks from one row of totals."""
    named = with_figures(totals, *checks)
    return named.select(F.inline(F.array(*[c.result() for c in checks]))).select(*RESULT_FIELDS)


def when_any(count: Column, *message: Column | str) -> Column:
    """An issue line that appears only for a non-zero count."""
    parts = [F.lit(m) if isinstance(m, str) else m for m in message]
    return F.when(count > 0, F.concat(*parts))

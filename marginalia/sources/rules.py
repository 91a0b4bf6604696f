"""Rule sets: built in, user-supplied JSON, and as a table."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from marginalia.functions.patterns import Signal, check_patterns, split_signal
from marginalia.schemas import RULE_TABLE
from marginalia.sources.paths import require_path
from marginalia.sources.vocabulary import BUILT_IN_RULES


@dataclass(frozen=True)
class RuleSet:
    """Ordered labels with their patterns. Declaration order breaks ties; the last label
    is the default where no pattern is found."""

    task: str
    rules: Mapping[str, list[str]]
    signals: dict[str, list[Signal]] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(
            self, "signals", {label: [split_signal(p) for p in ps] for label, ps in self.rules.items()}
        )

    @property
    def labels(self) -> list[str]:
        return list(self.rules)

    @property
    def patterns(self) -> list[str]:
        return [p for ps in self.rules.values() for p in ps]

    @property
    def vocabulary(self) -> set[str]:
        return {w for signals in self.signals.values() for s in signals for w in s.vocabulary}


def resolve_rules(task: str, rules: Mapping[str, list[str]] | None = None) -> RuleSet:
    """Non-empty custom rules win, then the built-in task, else ValueError."""
    if rules:
        return RuleSet(task, dict(rules))
    if task not in BUILT_IN_RULES:
        raise ValueError(
            f"unknown task {task!r} and no rules given; built-in tasks: {sorted(BUILT_IN_RULES)}"
        )
    return RuleSet(task, BUILT_IN_RULES[task])


def scan_rules(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Read a JSON object label -> patterns; keys starting with "_" are remarks."""
    require_path(spark, path)
    # A rule file is configuration: one small document the driver needs to build the plan.
    body = spark.read.text(path, wholetext=True).first()
    loaded = json.loads(body["value"]) if body else None
    if not isinstance(loaded, dict):
        raise ValueError("a rule file must hold one JSON object: label -> list of patterns")
    rules = {label: patterns for label, patterns in loaded.items() if not label.startswith("_")}
    check_patterns(spark, [p for patterns in rules.values() for p in patterns])
    return rules


def rules_table(spark: SparkSession, *rule_sets: RuleSet) -> DataFrame:
    """One row per pattern: task, label, label_ord, signal_ord, pattern."""
    rows = [
        (rule_set.task, label, label_ord, signal_ord, pattern)
        for rule_set in rule_sets
        for label_ord, (label, patterns) in enumerate(rule_set.rules.items())
        for signal_ord, pattern in enumerate(patterns)
    ]
    return spark.createDataFrame(rows, RULE_TABLE)

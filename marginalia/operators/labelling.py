"""Label texts by counting which patterns of each label they contain.

Everything is one narrow projection of native expressions: no shuffle, no Python worker,
and it runs unchanged on a streaming DataFrame. Rule sets are plan-time constants, so
patterns and word lists are literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.patterns import fold_case, known_words, signal_found
from marginalia.functions.text import is_blank
from marginalia.operators.once import compute_once
from marginalia.sources.rules import RuleSet

UNKNOWN_LABEL = "Unknown"
METHOD = "rule_based"


def _add(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _count_arrays(rule_sets: Sequence[RuleSet], text: Column, words: Column, folded: Column) -> list[Column]:
    """Per rule set: array of matched patterns per label, in declaration order."""
    return [
        F.array(
            *[
                _add([signal_found(s, text, folded, words).cast("int") for s in signals])
                if signals
                else F.lit(0)
                for signals in rule_set.signals.values()
            ]
        )
        for rule_set in rule_sets
    ]


def _prediction(rule_set: RuleSet, counts: Column, blank: Column) -> Column:
    """struct(label, confidence, signals, method) from the per-label counts."""
    labels = rule_set.labels
    k = len(labels)
    # One integer holds count and reversed position: its maximum is the highest count and,
    # among equal counts, the label declared first.
    codes = [counts[i] * k + (k - 1 - i) for i in range(k)]
    best = F.greatest(*codes) if k > 1 else codes[0]
    found = best >= k  # some count is at least 1
    position = (F.lit(k - 1) - best % k).cast("int")
    label_list = F.array(*[F.lit(label) for label in labels])
    # Every possible confidence is known now: matched / declared per label, 4 decimals.
    widest = max(len(ps) for ps in rule_set.rules.values())
    rows = [
        [f"{round(min(c / max(len(ps), 1), 1.0), 4)}D" for c in range(widest + 1)]
        for ps in rule_set.rules.values()
    ]
    scores = F.expr(f"array({', '.join('array(' + ', '.join(row) + ')' for row in rows)})")
    matched = F.floor(best / k).cast("int")
    label = F.when(found, label_list[position]).otherwise(F.lit(labels[-1]))
    confidence = F.when(found, scores[position][matched]).otherwise(F.lit(0.0))
    signals = F.map_from_arrays(label_list, counts)
    no_signals = F.create_map().cast("map<string,int>")
    return F.struct(
        F.when(blank, UNKNOWN_LABEL).otherwise(label).alias("label"),
        F.when(blank, 0.0).otherwise(confidence).alias("confidence"),
        F.when(blank, no_signals).otherwise(signals).alias("signals"),
        F.lit(METHOD).alias("method"),
    )


def predict(df: DataFrame, rule_sets: Sequence[RuleSet], text_col: str = "text") -> DataFrame:
    """Add one prediction struct per rule set, named ``prediction_<position>``.

    The text is split into words once, however many rule sets look at it.
    """
    text = F.col(text_col)
    vocabulary = set().union(*[r.vocabulary for r in rule_sets])
    kept = [F.col(f"`{c}`") for c in df.columns]
    folded = df.select(*kept, fold_case(text).alias("__folded"))
    split = folded.withColumn("__words", known_words(F.col("__folded"), vocabulary))
    counts = _count_arrays(rule_sets, text, F.col("__words"), F.col("__folded"))
    counted = compute_once(
        split, kept, {"__blank": is_blank(text), **{f"__counts_{i}": c for i, c in enumerate(counts)}}
    )
    return counted.select(
        *kept,
        *[
            _prediction(r, F.col(f"__counts_{i}"), F.col("__blank")).alias(f"prediction_{i}")
            for i, r in enumerate(rule_sets)
        ],
    )


def label(df: DataFrame, rule_set: RuleSet, text_col: str = "text") -> DataFrame:
    """Add auto_label, auto_confidence and auto_signals."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    return predict(df, [rule_set], text_col).select(
        *kept,
        F.col("prediction_0.label").alias("auto_label"),
        F.col("prediction_0.confidence").alias("auto_confidence"),
        F.col("prediction_0.signals").alias("auto_signals"),
    )


def label_tasks(df: DataFrame, rule_sets: Sequence[RuleSet], text_col: str = "text") -> DataFrame:
    """Label every row for several tasks in one pass; one output row per input row and task."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    per_task = F.array(
        *[
            F.struct(F.lit(r.task).alias("task"), F.col(f"prediction_{i}").alias("prediction"))
            for i, r in enumerate(rule_sets)
        ]
    )
    return (
        predict(df, rule_sets, text_col)
        .select(*kept, F.explode(per_task).alias("__hit"))
        .select(
            *kept,
            F.col("__hit.task").alias("task"),
            F.col("__hit.prediction.label").alias("auto_label"),
            F.col("__hit.prediction.confidence").alias("auto_confidence"),
            F.col("__hit.prediction.signals").alias("auto_signals"),
        )
    )


def signal_hits(df: DataFrame, rule_sets: Sequence[RuleSet], text_col: str = "text") -> DataFrame:
    """Rows per pattern that contain it: task, label, label_ord, signal_ord, pattern, hits.

    Shows which rules carry a task and which never fire. One pass, one tiny aggregate.
    """
    text, folded, words = F.col("__text"), F.col("__folded"), F.col("__words")
    vocabulary = set().union(*[r.vocabulary for r in rule_sets])
    prepared = df.select(F.col(text_col).alias("__text"), fold_case(F.col(text_col)).alias("__folded"))
    prepared = prepared.withColumn("__words", known_words(folded, vocabulary))
    signals = [
        (rule_set.task, name, label_ord, signal_ord, signal)
        for rule_set in rule_sets
        for label_ord, (name, found) in enumerate(rule_set.signals.items())
        for signal_ord, signal in enumerate(found)
    ]
    totals = prepared.agg(
        *[F.count_if(signal_found(s, text, folded, words)).alias(f"h{i}") for i, (*_, s) in enumerate(signals)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(task).alias("task"),
                F.lit(name).alias("label"),
                F.lit(label_ord).alias("label_ord"),
                F.lit(signal_ord).alias("signal_ord"),
                F.lit(s.pattern).alias("pattern"),
                F.col(f"h{i}").alias("hits"),
            )
            for i, (task, name, label_ord, signal_ord, s) in enumerate(signals)
        ]
    )
    return totals.select(F.inline(rows))

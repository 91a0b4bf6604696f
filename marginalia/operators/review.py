"""Human decisions as a table laid over automatic labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.numbers import percent
from marginalia.operators.records import AUTO_ANNOTATOR, record_fields
from marginalia.sources.layout import small_enough
from marginalia.sources.rules import RuleSet

ACCEPT, SKIP, QUIT = "", "s", "q"
REVIEW_THRESHOLD = 0.15


def effective_decisions(decisions: DataFrame, labels: list[str]) -> DataFrame:
    """One decision per source_id: the latest valid one given before its session ended.

    ``decisions``: source_id, choice, annotator, time_sec, seq. A session is all
    decisions of one annotator in ``seq`` order; from its first quit on, nothing counts.
    Invalid choices are ignored, as if asked again.
    """
    choice = F.lower(F.trim(F.coalesce("choice", F.lit(""))))
    # A missing annotator is one session too; equality on NULL would lose it in the join.
    cleaned = decisions.select(
        "source_id", choice.alias("choice"), F.coalesce("annotator", F.lit("")).alias("annotator"), "time_sec", "seq"
    )
    # Aggregates, not windows: they combine map-side, so an annotator or item holding a
    # third of all decisions never gathers in one task.
    ends = cleaned.filter(F.col("choice") == QUIT).groupBy("annotator").agg(F.min("seq").alias("__end"))
    numbers = [str(i + 1) for i in range(len(labels))]
    alive = (
        cleaned.filter(F.col("choice").isin(ACCEPT, SKIP, *numbers))
        .join(ends, "annotator", "left")
        .filter(F.col("__end").isNull() | (F.col("seq") < F.col("__end")))
    )
    latest = alive.groupBy("source_id").agg(
        F.max(F.struct("seq", "annotator", "choice", "time_sec")).alias("d")
    )
    chosen = F.get(F.array(*[F.lit(x) for x in labels]), F.col("d.choice").try_cast("int") - 1)
    return latest.select(
        "source_id",
        F.col("d.choice").alias("choice"),
        chosen.alias("chosen_label"),
        F.col("d.annotator").alias("annotator"),
        F.col("d.time_sec").alias("time_sec"),
    )


def apply_reviews(
    labelled: DataFrame,
    decisions: DataFrame,
    rule_set: RuleSet,
    *,
    id_col: str = "_id",
    text_col: str = "_text",
    record_ids: str = "uuid",
) -> DataFrame:
    """Records with decisions applied; items without one stay automatic.

    Accepting and skipping both keep the automatic label and count as reviewed.

    Human decisions are few next to the texts. Where the decisions table is within the
    broadcast limit, so is what is left of it (at most one row each), and the texts stay
    where they are; saying so up front matters, as the planner's own estimate for a
    derived table is too high and the texts would be shuffled before it could learn
    better. Beyond the limit it is a sort-merge join with adaptive skew splitting.
    """
    chosen = effective_decisions(decisions, rule_set.labels).withColumnsRenamed(
        {"source_id": "__id", "annotator": "__who", "time_sec": "__took", "choice": "__choice"}
    )
    if small_enough(decisions):
        chosen = F.broadcast(chosen)
    joined = labelled.join(chosen, F.col(id_col).cast("string") == F.col("__id"), "left")
    reviewed = F.col("__id").isNotNull()
    return record_fields(
        joined,
        rule_set.task,
        id_col=id_col,
        text_col=text_col,
        final=F.when(reviewed, F.coalesce("chosen_label", "auto_label")),
        annotator=F.when(reviewed, F.col("__who")).otherwise(F.lit(AUTO_ANNOTATOR)),
        reviewed=reviewed,
        seconds=F.when(reviewed, F.coalesce("__took", F.lit(0.0))).otherwise(F.lit(0.0)),
        record_ids=record_ids,
    )


def review_counts(records: DataFrame) -> DataFrame:
    """One row: total, auto, human, override."""
    return records.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("is_human_reviewed")).alias("auto"),
        F.count_if("is_human_reviewed").alias("human"),
        F.count_if("human_override").alias("override"),
        percent(F.count_if("human_override"), F.count_if("is_human_reviewed")).alias("override_rate_pct"),
    )


def review_queue(labelled: DataFrame, threshold: float = REVIEW_THRESHOLD, id_col: str = "_id") -> DataFrame:
    """Items a reviewer should see, least certain first."""
    return labelled.filter(F.col("auto_confidence") < threshold).orderBy("auto_confidence", id_col)

"""End-to-end jobs: label a file; check a labelled file; compare two annotators."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marginalia.operators.agreement import check_inter_annotator
from marginalia.operators.labelling import label
from marginalia.operators.records import label_batch
from marginalia.operators.review import apply_reviews
from marginalia.operators.rowchecks import LOW
from marginalia.plans.qa_suite import label_metrics, run_checks
from marginalia.sources.annotated import scan_annotated, scan_gold
from marginalia.sources.paths import stored
from marginalia.sources.readers import load
from marginalia.sources.rules import resolve_rules, scan_rules
from marginalia.sources.writers import export, write_check_results


def label_file(
    spark: SparkSession,
    path: str,
    task: str,
    folder: str,
    *,
    rules_path: str | None = None,
    decisions: DataFrame | None = None,
    mode: str = "csv",
    text_col: str | None = None,
    id_col: str | None = None,
    limit: int | None = None,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
    review_below: float | None = None,
    run_id: str | None = None,
) -> dict[str, str]:
    """Read, clean, label, overlay decisions where given, and write every output.

    Outputs go to a folder of the task and run, so runs into one ``folder`` stay apart and it
    reads as one table partitioned by both. A run is named by its time unless ``run_id`` names it;
    a name that was used is refused.
    """
    run_id = run_id or f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    rule_set = resolve_rules(task, scan_rules(spark, rules_path) if rules_path else None)
    texts = load(spark, path, text_col, id_col, limit, multi_line, format, schema)
    if decisions is None:
        records = label_batch(texts, rule_set)
    else:
        records = apply_reviews(label(texts, rule_set, "_text"), decisions, rule_set)
    return export(spark, records, f"{folder}/task={rule_set.task}/run={run_id}", rule_set, mode, review_below)


def check_file(
    spark: SparkSession,
    path: str,
    folder: str,
    *,
    gold_path: str | None = None,
    other_path: str | None = None,
    threshold: float = LOW,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Check an annotated file, write check rows and metrics, return the check rows.

    The last three options say how all the files are read; CSV where nothing tells.
    """
    how = (multi_line, format, schema)
    table = stored(scan_annotated(spark, path, *how), "annotated")
    gold = scan_gold(spark, gold_path, *how) if gold_path else None
    other = scan_annotated(spark, other_path, *how) if other_path else None
    checks = stored(run_checks(table, threshold, gold, other), "checks")
    write_check_results(checks, label_metrics(table, gold, other), folder, path.rsplit("/", 1)[-1])
    return checks


def compare_annotators(
    spark: SparkSession,
    path_a: str,
    path_b: str,
    *,
    multi_line: bool = True,
    format: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Agreement between two annotated files; a skipped row where they share no id."""
    tables = [scan_annotated(spark, path, multi_line, format, schema) for path in (path_a, path_b)]
    return check_inter_annotator(*tables)

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Each query runs once to warm up (class loading, code generation) and is then timed end to
end, plan building included; results go to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from marginalia.plans import catalog

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = [
    "R7_label_batch",
    "R8_label_rules_table",
    "S8_builtin_rules",
    "H1_apply_reviews",
    "A1_annotation_summary",
    "J1_iaa_join_repeated_ids",
    "Q1_check_completeness",
    "Q2_check_confidence_values",
    "Q3_check_label_distribution",
    "Q5_check_inter_annotator",
    "Q6_check_duplicates",
    "Q6a_duplicate_label_conflicts",
    "Q7_check_text_quality",
    "Q8_check_golden_set",
    "Q9_check_override_analysis",
    "Q10_run_all_checks",
    "Q12_qa_report_rows",
    "K1_sink_csv",
    "K2_sink_jsonl",
    "S1_scan_csv",
    "X8_stream_label",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    catalog.registered()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    catalog.flagship(spark, SF_DIR).collect()
    start = time.perf_counter()
    catalog.flagship(spark, SF_DIR).collect()
    seconds["flagship"] = time.perf_counter() - start
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = run(spark, name)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
                "documents_labelled_per_sec": round(docs / seconds["R7_label_batch"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

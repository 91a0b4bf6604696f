import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.operators import agreement, distribution, duplicates, golden, overrides, reliability, rowchecks
from marginalia.operators.median import exact_median
from marginalia.plans import qa_suite

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def plain(n):
    return [(f"Sample text number {i}", "AB"[i % 2], "AB"[i % 2]) for i in range(n)]


def test_completeness(annotated):
    rows = plain(20)
    rows[0] = ("x y z", "", "A")
    rows[1] = (" \t", "nan", "None")
    rows[2] = ("x y z", "None", "A")
    rows[3] = ("x y z", "Nan", "A")  # exact spelling only
    got = row(rowchecks.check_completeness(annotated(rows)))
    assert (got["missing_labels"], got["empty_text"], got["missing_auto_labels"]) == (3, 1, 1)
    assert got["passed"] is False and got["completeness_pct"] == 80.0
    assert got["issues"] == [
        "3 records have no final_label", "1 records have empty text", "1 records have no auto_label",
    ]
    noted = row(rowchecks.check_completeness(annotated([("t", "A", "null", math.nan, False, False)])))
    assert noted["passed"] is True and noted["missing_confidence"] == 1 and noted["missing_auto_labels"] == 1
    empty = row(rowchecks.check_completeness(annotated(plain(1)).limit(0)))
    assert empty["completeness_pct"] == 0.0 and empty["passed"] is True


def confidences(annotated, values):
    return annotated([("some text", "A", "A", v, False, False) for v in values])


def test_confidence_buckets_and_gate(annotated):
    values = [0.0, 0.1, 0.2, 0.3, 0.4, 0.69, 0.7, 1.0, math.nan]
    got = row(rowchecks.check_confidence(confidences(annotated, values)))
    assert [got[b] for b in ("zero", "very_low", "low", "medium", "high")] == [1, 1, 2, 2, 2]
    assert got["needs_review_count"] == 2 and got["needs_review_pct"] == 25.0 and got["passed"] is True
    assert got["std"] == round(statistics.stdev(values[:-1]), 4) and got["median"] == 0.35
    assert got["issues"] == ["2 items (25.0%) below confidence threshold 20%"]
    wide = row(rowchecks.check_confidence(confidences(annotated, values), 0.5))
    assert wide["very_low"] == 4 and wide["low"] == 2 and wide["passed"] is False
    zero = row(rowchecks.check_confidence(confidences(annotated, [0.0] * 20)))
    assert zero["needs_review_count"] == 20
    # The gate looks at the rounded share: 29.996 % rounds to 30.0.
    gate = [0.0] * 7499 + [1.0] * 17501
    assert row(rowchecks.check_confidence(confidences(annotated, gate)))["passed"] is False
    one = row(rowchecks.check_confidence(confidences(annotated, [0.5])))
    assert one["std"] is None and one["median"] == 0.5
    none = row(rowchecks.check_confidence(confidences(annotated, [0.5]).limit(0)))
    assert none["mean"] == 0.0 and none["median"] == 0.0 and none["passed"] is True and none["issues"] == []


@quick
@given(st.lists(st.floats(-1e6, 1e6) | st.floats(0, 1) | st.sampled_from([0.0, 0.25, 1e-300]), max_size=60))
def test_median_of_anything(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double").repartition(3)
    got = row(exact_median(df, "x"))["median"]
    if values:
        assert got == pytest.approx(statistics.median(values), rel=1e-12, abs=0)
    else:
        assert got is None


def test_label_distribution(annotated):
    got = row(distribution.check_label_distribution(annotated(plain(20))))
    assert (got["n_classes"], got["gini_coefficient"], got["passed"]) == (2, 0.0, True)
    assert got["auto_final_agreement_pct"] == 100.0
    skewed = [("t", "A", "B")] * 95 + [("t", x, x) for x in "BCDEF"]
    got = row(distribution.check_label_distribution(annotated(skewed)))
    assert got["passed"] is False and got["gini_coefficient"] > 0.6 and got["auto_final_agreement_pct"] == 5.0
    assert got["issues"] == ["'A' is heavily dominant (95.0% vs expected 16.7%)"]
    single = row(distribution.check_label_distribution(annotated([("t", "A", "A")])))
    assert single["gini_coefficient"] == 0.0 and single["passed"] is True
    empty = row(distribution.check_label_distribution(annotated(plain(1)).limit(0)))
    assert empty["n_classes"] == 0 and empty["passed"] is True


@quick
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_gini_follows_its_formula(spark, sizes):
    df = spark.createDataFrame([(f"l{i}",) for i, n in enumerate(sizes) for _ in range(n)], "final_label string")
    got = row(distribution.check_label_distribution(df))
    k, shares = len(sizes), sorted(n / sum(sizes) for n in sizes)
    want = (2 * sum(i * f for i, f in enumerate(shares, 1)) - (k + 1)) / k if k > 1 else 0.0
    assert got["gini_coefficient"] == pytest.approx(want, abs=6e-5)
    assert 0 <= got["gini_coefficient"] <= (k - 1) / k + 1e-4 and got["auto_final_agreement_pct"] is None


def test_duplicates_and_conflicts(annotated):
    clean = row(duplicates.check_duplicates(annotated(plain(20))))
    assert clean["exact_duplicates"] == 0 and clean["passed"] is True
    rows = [(f" Text \n {i}", x, "A") for i in range(7) for x in "AB"] + [("text 0", "A", "A"), ("alone", "A", "A")]
    df = annotated(rows)
    got = row(duplicates.check_duplicates(df))
    assert got["exact_duplicates"] == 15 and got["duplicate_pct"] == 93.75
    assert got["label_conflicts"] == 5 and got["label_conflicts_total"] == 7
    assert got["issues"] == ["15 duplicate texts found (7 with conflicting labels)"]
    assert duplicates.duplicate_label_conflicts(df).count() == 7
    shown = duplicates.duplicate_label_conflicts(df, 5).collect()
    assert [(r["text_key"], r["copies"], r["labels"]) for r in shown] == [("text 0", 3, 2)] + [
        (f"text {i}", 2, 2) for i in range(1, 5)
    ]
    empty = row(duplicates.check_duplicates(df.limit(0)))
    assert empty["skipped"] is True and empty["passed"] is None


def test_text_quality(annotated):
    rows = [("Hi", "A", "A"), ("x" * 5001, "A", "A"), ("broken � text", "A", "A"), ("SHOUTING ALL DAY", "A", "A"),
            ("what?!!", "A", "A"), ("fine text", "A", "A")]
    got = row(rowchecks.check_text_quality(annotated(rows)))
    assert [got[c] for c in ("too_short", "too_long", "encoding_issues", "all_caps", "excess_punctuation")] == [1] * 5
    assert got["passed"] is False and len(got["issues"]) == 3
    assert (got["min_length"], got["max_length"]) == (2, 5001)
    assert got["median_length"] == statistics.median(len(r[0]) for r in rows)
    noted = row(rowchecks.check_text_quality(annotated(rows[3:])))
    assert noted["passed"] is True and noted["all_caps"] == 1
    assert row(rowchecks.check_text_quality(annotated(rows).limit(0)))["skipped"] is True


def labels(spark, pairs, name="final_label"):
    return spark.createDataFrame(pairs, f"source_id string, {name} string")


def kappa_of(a, b):
    n = len(a)
    observed = sum(x == y for x, y in zip(a, b)) / n
    expected = sum(a.count(c) * b.count(c) for c in set(a) | set(b)) / (n * n)
    return round((observed - expected) / (1 - expected), 4) if 1 - expected > 0 else 1.0


@quick
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("ABCD")), min_size=1, max_size=40))
def test_kappa_follows_its_formula_and_is_symmetric(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = row(agreement.cohens_kappa(agreement.confusion_counts(df, "a", "b")))["kappa"]
    assert got == pytest.approx(kappa_of(*map(list, zip(*pairs))), abs=1.1e-4)
    assert got == row(agreement.cohens_kappa(agreement.confusion_counts(df, "b", "a")))["kappa"]
    assert row(agreement.cohens_kappa(agreement.confusion_counts(df, "a", "a")))["kappa"] == 1.0


def test_kappa_extremes(spark):
    swapped = spark.createDataFrame([("A", "B")] * 50 + [("B", "A")] * 50, "a string, b string")
    assert row(agreement.cohens_kappa(agreement.confusion_counts(swapped, "a", "b")))["kappa"] == -1.0
    assert row(agreement.cohens_kappa(agreement.confusion_counts(swapped.limit(0), "a", "b")))["kappa"] == 0.0


def test_agreement_with_repeated_ids(spark):
    random.seed(7)
    a = [(str(random.choice([0, 0, 0, 1, 2, 3])), random.choice("AB")) for _ in range(60)]
    b = [(str(random.choice([0, 0, 1, 2, 9])), random.choice("ABC")) for _ in range(50)]
    joined = [(x, y) for i, x in a for j, y in b if i == j]
    got = row(agreement.check_inter_annotator(labels(spark, a), labels(spark, b)))
    assert got["shared_items"] == len(joined)
    assert got["exact_agreement_pct"] == round(sum(x == y for x, y in joined) / len(joined) * 100, 2)
    assert got["cohens_kappa"] == kappa_of(*map(list, zip(*joined)))
    assert got["disagreement_count"] == sum(x != y for x, y in joined)
    assert agreement.join_annotators(labels(spark, a), labels(spark, b)).count() == len(joined)
    top = agreement.top_conflicts(agreement.paired_counts(labels(spark, a), labels(spark, b), "source_id")).collect()
    want = {}
    for x, y in joined:
        if x != y:
            want[x, y] = want.get((x, y), 0) + 1
    want = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [((r["final_label_a"], r["final_label_b"]), r["count"]) for r in top] == want


def test_agreement_without_shared_ids_is_skipped(spark):
    got = row(agreement.check_inter_annotator(labels(spark, [("1", "A")]), labels(spark, [("2", "A")])))
    assert got["skipped"] is True and got["passed"] is None and got["reason"] == "No shared IDs found."


def test_confusion_matrix_and_label_union(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), ("C", "B")], "a string, b string")
    matrix = agreement.confusion_matrix(agreement.confusion_counts(df, "a", "b"), ["A", "B", "C"])
    assert sorted(tuple(r) for r in matrix.collect()) == [("A", 1, 1, 0), ("C", 0, 1, 0)]
    assert {r[0] for r in agreement.label_union(df, "a", "b").collect()} == {"A", "B", "C"}


def test_golden_set(spark, annotated):
    df = annotated([("t", "A", x) for x in "AAABBBCC"])  # ids id_0000 ... id_0007
    gold = labels(spark, [(f"id_{i:04d}", x) for i, x in enumerate("AABBBBBD")])
    got = row(golden.check_golden_set(df, gold))
    assert (got["n_validated"], got["accuracy_pct"], got["passed"]) == (8, 62.5, False)
    assert got["issues"] == ["Accuracy 62.5% below 70% target"]
    scores = {r["label"]: r for r in golden.per_label_scores(golden.gold_counts(df, gold)).collect()}
    assert set(scores) == set("ABCD")
    assert (scores["A"]["precision"], scores["A"]["recall"], scores["A"]["f1"]) == (0.6667, 1.0, 0.8)
    assert (scores["D"]["precision"], scores["D"]["recall"], scores["D"]["support"]) == (0.0, 0.0, 1)
    assert got["macro_f1"] == round(sum(s["f1"] for s in scores.values()) / 4, 4)
    perfect = row(golden.check_golden_set(df, df.select("source_id", F.col("auto_label").alias("final_label"))))
    assert perfect["accuracy_pct"] == 100.0 and perfect["macro_f1"] == 1.0
    missing = row(golden.check_golden_set(df, labels(spark, [("zzz", "A")])))
    assert missing["skipped"] is True and missing["reason"] == "No matching IDs found."


def reviewed_rows(n_reviewed, n_overrides, confidence=0.1):
    return [
        ("t", "B" if i < n_overrides else "A", "A", confidence, True, i < n_overrides) for i in range(n_reviewed)
    ]


def test_overrides(annotated):
    rows = reviewed_rows(4, 2) + reviewed_rows(4, 1, 0.7) + [("t", "B", "A", 0.1, False, False)]
    df = annotated(rows)
    got = row(overrides.check_override_analysis(df))
    assert (got["human_reviewed"], got["overrides"], got["overall_override_rate_pct"]) == (8, 3, 37.5)
    assert got["passed"] is False and "rules for 'A'" in got["issues"][0]
    assert got["override_rate_0_20"] == 50.0 and got["override_rate_20_40"] is None and got["reviewed_70_up"] == 4.0
    bands = {r["band"]: (r["reviewed"], r["overrides"], r["override_rate"]) for r in overrides.override_by_band(df).collect()}
    assert bands == {"0%–20%": (4, 2, 50.0), "≥70%": (4, 1, 25.0)}
    moves = [tuple(r) for r in overrides.override_from_to(df).collect()]
    assert moves == [("from", "A", 3), ("to", "B", 3)]


def test_override_rate_at_the_limit_neither_warns_nor_passes(annotated):
    got = row(overrides.check_override_analysis(annotated(reviewed_rows(4, 1))))
    assert got["overall_override_rate_pct"] == 25.0 and got["passed"] is False and got["issues"] == []


def test_overrides_skip_and_derive(annotated):
    none = row(overrides.check_override_analysis(annotated([("t", "B", "A")])))
    assert none["skipped"] is True and none["reason"] == overrides.NO_REVIEWS
    df = annotated(reviewed_rows(4, 1))
    bare = row(overrides.check_override_analysis(df.drop("is_human_reviewed")))
    assert bare["skipped"] is True and bare["reason"] == overrides.NO_COLUMN
    derived = row(overrides.check_override_analysis(df.drop("human_override")))
    assert derived["overrides"] == 1


def test_suite_order_verdict_and_report(spark, annotated):
    rows = plain(40)
    rows[3] = ("Hi", "B", "A", 0.1, True, True)
    df = annotated(rows)
    gold = df.select("source_id", F.col("final_label"))
    checks = qa_suite.run_checks(df, gold=gold, other=df)
    got = {r["check"]: r for r in checks.collect()}
    assert [r["check"] for r in sorted(got.values(), key=lambda r: r["ord"])] == qa_suite.CHECK_ORDER
    failed = {name for name, r in got.items() if r["passed"] is False}
    assert failed == {"Text Quality", "Override Analysis"}
    verdict = row(qa_suite.overall_verdict(checks))
    assert verdict == {"status": "FAIL", "n_pass": 6, "n_fail": 2, "n_skip": 0}
    report = qa_suite.report_rows(df, checks, gold, df).collect()
    assert ("overall", "status", "status", "FAIL", None) in [tuple(r) for r in report]
    assert {r["section"] for r in report} == {"overall", "labels", "checks", "figures", "details"}
    small = qa_suite.run_checks(df.drop("is_human_reviewed", "human_override"))
    verdict = row(qa_suite.overall_verdict(small))
    assert verdict == {"status": "FAIL", "n_pass": 4, "n_fail": 1, "n_skip": 1}


def alpha_of(items):
    units = [u for u in items.values() if len(u) > 1]
    values = [v for u in units for v in u]
    n = len(values)
    if not n:
        return None
    observed = sum(
        sum(x != y for i, x in enumerate(u) for j, y in enumerate(u) if i != j) / (len(u) - 1) for u in units
    )
    expected = sum(x != y for i, x in enumerate(values) for j, y in enumerate(values) if i != j) / (n - 1)
    return 1 - observed / expected if expected else 1.0


@quick
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ABC")), max_size=40))
def test_alpha_follows_its_formula(spark, ratings):
    items = {}
    for item, label in ratings:
        items.setdefault(item, []).append(label)
    got = row(reliability.krippendorff_alpha(spark.createDataFrame(ratings, "item int, label string")))
    want = alpha_of(items)
    assert got["n_items"] == sum(len(u) > 1 for u in items.values())
    assert (got["alpha"] is None) == (want is None)
    if want is not None:
        assert got["alpha"] == pytest.approx(want, abs=6e-5)


def test_drift_is_total_variation(spark):
    rows = [("d1", "A")] * 3 + [("d1", "B")] + [("d2", "B")] * 4 + [("d3", "C")] * 2
    got = {r["batch"]: r["drift"] for r in reliability.label_drift(spark.createDataFrame(rows, "b string, l string"), "b", "l").collect()}
    share = {"A": 0.3, "B": 0.5, "C": 0.2}
    local = {"d1": {"A": 0.75, "B": 0.25}, "d2": {"B": 1.0}, "d3": {"C": 1.0}}
    for batch, here in local.items():
        assert got[batch] == round(sum(abs(here.get(x, 0) - share[x]) for x in share) / 2, 4)


def test_scorecard(spark):
    records = spark.createDataFrame(
        [("ann", "t", str(i), i, "A", 10.0) for i in range(20)], "annotator string, task string, source_id string, created_at int, final_label string, annotation_time_sec double"
    )
    gold = labels(spark, [(str(i), "A" if i < 7 else "B") for i in range(20)])
    assigned = spark.createDataFrame([("ann", "t", 21)], "annotator string, task string, n_assigned int")
    got = row(reliability.annotator_scorecard(records, gold, assigned))
    assert got["items_per_hour"] == 360.0 and got["completion_pct"] == 95.24 and got["completion_ok"] is True
    assert got["n_calibration"] == 10 and got["calibration_pct"] == 70.0 and got["calibration_ok"] is False


def test_median_with_infinities(spark):
    from marginalia.operators.median import exact_median

    values = [(float("inf"),), (float("-inf"),), (0.25,), (0.5,), (float("inf"),)]
    assert exact_median(spark.createDataFrame(values, "v double"), "v").first()["median"] == 0.5

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.functions.patterns import check_patterns, necessary_parts, split_signal, to_java
from marginalia.operators.labelling import label, label_tasks, signal_hits
from marginalia.operators.records import label_batch, record_fields, record_view
from marginalia.schemas import RECORD, RECORD_FIELDS
from marginalia.sources.rules import RuleSet, resolve_rules, rules_table
from marginalia.sources.vocabulary import BUILT_IN_RULES, LANGUAGE_RULES, SHOP_RULES


def expected(rules, text):
    """What a rule author expects: straight from the definition, one text at a time."""
    if text is None or not text.strip():
        return "Unknown", 0.0, {}
    hits = {
        name: sum(bool(re.search(p, text, re.IGNORECASE)) for p in patterns)
        for name, patterns in rules.items()
    }
    top = max(hits.values())
    if top == 0:
        return list(rules)[-1], 0.0, hits
    winner = next(name for name, n in hits.items() if n == top)
    return winner, round(min(top / len(rules[winner]), 1.0), 4), hits


def check(df, rules, task="any"):
    got = label(df, RuleSet(task, rules), "_text").collect()
    assert len(got) == df.count()
    for row in got:
        want = expected(rules, row["_text"])
        assert (row["auto_label"], row["auto_confidence"], row["auto_signals"]) == want, row["_text"]


TRICKY = [
    "I love it, amazing!",
    "TERRIBLE and broken; refund please",
    "it is okay",
    "rip-off", "ripoff", "rip  off", "a RIP.OFF!",
    "cheap   quality", "cheap quality",
    "I didn't, you don't belong here",
    "frustrated", "frustrat", "x-rated", "xrated", "18+", "18+a", "18+ a",
    "100% free", "100%  free", "1100% free",
    "http://a http://b http://c", "http://ahttp://bhttps://c", "$5$6", "$5 $6", "$٣$٤",
    "hate all", "hate those", "hateall", "KILL \x1c every",
    "What?\r", "What?\n", "What?\n\n", "What? ",
    "❤", "️", "😞 and 🥰", "➿",
    "ébad bad", "bad́", "_bad_", "bad1", "bád",
    "ﬁne FİNE fıne Kill ſlow", "ſcam", "BOOK", "book",
    "hello ", "wordlove", "love_", "ⅷlove", "love²",
    "   ", "\t \n", "",
    "no signal whatsoever zzz",
]


@pytest.mark.parametrize("task", list(BUILT_IN_RULES))
def test_built_in_rules_on_tricky_texts(texts, task):
    check(texts(*TRICKY), BUILT_IN_RULES[task], task)


def test_shop_and_language_rules_on_tricky_texts(texts):
    check(texts(*TRICKY), SHOP_RULES)
    check(texts(*TRICKY, "the le der el", "la que las", "por que"), LANGUAGE_RULES)


def test_user_patterns_of_every_kind(texts):
    rules = {
        "A": [r"\bcat\b", r"^dog", r"colou?r", r"[^\w\s]{2}", r"\d{3}", r"(?P<x>ab)(?P=x)", r"\Bend\Z"],
        "B": [r"[[a]b]", r"[]x]y", r"[^]]q", r"a{,2}b", r"\bÉtat\b", r"(one|two)\W+three", r"\b(cat|dog)\b|zebra"],
        "C": [r"\S+@\S+", r"[\w.]+\.txt", r"(?:foo|bar)+baz", r"\b(red|blue) fish", r"a&&b", r"[&&x]z", r"tab\there"],
    }
    check(
        texts(
            "cat", "concat", "dog", "hot dog", "COLOR", "..", "123", "abab", "weekend", "end",
            "[ab]", "]y", "qq", "b", "état", "one, three", "two three", "zebras", "x@y", "notes.txt",
            "foobarbaz", "red fish", "a&&b", "&z", "tab\there", "²³¹", "one_three",
        ),
        rules,
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                ["love", "BAD", "rip off", "rip-off", "é", "İ", "K", "_", " ", " ", "\n", "?", "100% free",
                 "okay", "😊", "️", "didn't", "not sure", "1", "hate all", "click here", "x", "-"]
            ),
            max_size=7,
        ).map("".join),
        min_size=1,
        max_size=25,
    )
)
def test_random_texts_follow_the_definition(spark, rows):
    df = spark.createDataFrame([(t,) for t in rows], "_text string")
    check(df, BUILT_IN_RULES["sentiment"])
    check(df, BUILT_IN_RULES["content_category"])


def test_ties_go_to_the_first_and_silence_to_the_last_label(texts):
    rules = {"B": [r"\bx\b"], "A": [r"\bx\b"], "Z": [r"\by\b", r"\bw\b"]}
    got = {r["_text"]: r["auto_label"] for r in label(texts("x", "y", "q", "y x w"), RuleSet("t", rules), "_text").collect()}
    assert got == {"x": "B", "y": "Z", "q": "Z", "y x w": "Z"}


def test_null_text_is_unknown(spark):
    df = spark.createDataFrame([(None,), ("love",)], "text string")
    got = label(df, resolve_rules("sentiment")).collect()
    assert [(r["auto_label"], r["auto_confidence"], r["auto_signals"]) for r in got][0] == ("Unknown", 0.0, {})


def test_labels_do_not_depend_on_partitioning(texts):
    df = texts(*TRICKY)
    rule_set = resolve_rules("sentiment")
    once = label(df.coalesce(1), rule_set, "_text").select("_id", "auto_label")
    many = label(df.repartition(7), rule_set, "_text").select("_id", "auto_label")
    assert sorted(once.collect()) == sorted(many.collect())


def test_labelling_is_one_narrow_native_stage(spark, texts):
    plan = label(texts(*TRICKY), resolve_rules("sentiment"), "_text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_filter_on_the_label_does_not_repeat_the_text_work(spark, tmp_path):
    spark.createDataFrame([("love",)], "text string").write.parquet(str(tmp_path / "t"))
    df = label(spark.read.parquet(str(tmp_path / "t")), resolve_rules("sentiment"))
    plan = df.filter("auto_confidence > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_intersect") == 1


def test_label_tasks_gives_one_row_per_task(texts):
    sets = [resolve_rules(t) for t in BUILT_IN_RULES]
    got = label_tasks(texts(*TRICKY), sets, "_text").collect()
    assert len(got) == len(TRICKY) * 3
    for row in got:
        want = expected(BUILT_IN_RULES[row["task"]], row["_text"])
        assert (row["auto_label"], row["auto_confidence"], row["auto_signals"]) == want


def test_signal_hits_counts_texts_per_pattern(texts):
    got = {
        (r["task"], r["label"], r["signal_ord"]): r["hits"]
        for r in signal_hits(texts(*TRICKY), [resolve_rules("content_category")], "_text").collect()
    }
    for name, patterns in BUILT_IN_RULES["content_category"].items():
        for i, p in enumerate(patterns):
            want = sum(bool(re.search(p, t, re.IGNORECASE)) for t in TRICKY)
            assert got["content_category", name, i] == want, p


def test_rule_resolution():
    assert resolve_rules("anything", {"A": ["a"]}).labels == ["A"]
    assert resolve_rules("intent", {}).labels[0] == "Informational"
    with pytest.raises(ValueError):
        resolve_rules("custom")


def test_rules_table_keeps_order(spark):
    rows = rules_table(spark, resolve_rules("sentiment"), RuleSet("language", LANGUAGE_RULES)).collect()
    assert len(rows) == 18 + 7
    assert [r["label"] for r in rows if r["task"] == "language" and r["signal_ord"] == 0] == list(LANGUAGE_RULES)
    assert sum(len(ps) for rules in BUILT_IN_RULES.values() for ps in rules.values()) == 47


def test_bad_patterns_are_refused_before_the_job(spark):
    check_patterns(spark, [r"\bfine\b", r"(?P<a>x)"])
    with pytest.raises(ValueError):
        check_patterns(spark, ["(unclosed"])
    with pytest.raises(ValueError):
        check_patterns(spark, [r"(a)(?(1)b|c)"])  # conditional group: not in Java


def test_splitting_of_patterns():
    s = split_signal(r"\b(slow|didn't|rip.?off|not sure)\b")
    assert s.words == ("slow",)
    assert s.phrases == (("didn", "didn't"), ("not", "not sure"))
    assert s.rest == r"\b(rip.?off)\b" and s.rest_needs == ("rip",)
    assert necessary_parts(r"(https?://\S+){3,}") == ("http",)
    assert necessary_parts(r"[ab]") == ()
    assert to_java(r"[\w&&x]").endswith(r"[\p{L}\p{N}_\&\&x]")


def test_records_have_the_fixed_shape(texts):
    got = label_batch(texts("love it", "zzz"), resolve_rules("sentiment"))
    assert got.columns == RECORD_FIELDS
    assert [f.dataType for f in got.schema] == [f.dataType for f in RECORD]
    rows = got.collect()
    assert len({r["record_id"] for r in rows}) == 2
    assert all(r["annotator"] == "auto" and not r["is_human_reviewed"] and r["metadata"] == {} for r in rows)
    assert all(r["final_label"] == r["auto_label"] for r in rows)
    assert record_view(got).columns == RECORD_FIELDS


def test_record_override_rules(spark):
    df = spark.createDataFrame(
        [("1", "a", "X", 0.3, "X", True), ("2", "b", "X", 0.3, "Y", True), ("3", "c", "X", 0.3, None, True),
         ("4", "d", "X", 0.3, "", True), ("5", "e", "X", 0.3, "Y", False)],
        "_id string, _text string, auto_label string, auto_confidence double, passed string, seen boolean",
    ).withColumn("auto_signals", F.create_map().cast("map<string,int>"))
    rows = record_fields(
        df, "t", final=F.col("passed"), reviewed=F.col("seen"), seconds=F.lit(1.0005), record_ids="content"
    ).collect()
    assert [(r["final_label"], r["human_override"]) for r in rows] == [
        ("X", False), ("Y", True), ("X", True), ("X", True), ("Y", False),
    ]
    assert {r["annotation_time_sec"] for r in rows} == {round(1.0005, 3)}
    assert len({r["record_id"] for r in rows}) == 5

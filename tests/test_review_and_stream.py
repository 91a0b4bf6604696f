from pyspark.sql import functions as F

from marginalia.operators.labelling import label
from marginalia.operators.review import apply_reviews, effective_decisions, review_counts, review_queue
from marginalia.sources.rules import RuleSet, resolve_rules
from marginalia.streaming.label_stream import label_stream, windowed_label_counts

SENTIMENT = resolve_rules("sentiment")
COLUMNS = "source_id string, choice string, annotator string, time_sec double, seq long"


def decide(spark, *rows):
    return spark.createDataFrame([(i, c, a, 1.5, s) for s, (i, c, a) in enumerate(rows)], COLUMNS)


def test_choices(spark, texts):
    labelled = label(texts(*["love"] * 8), SENTIMENT, "_text")
    decisions = decide(
        spark, ("0", "", "ann"), ("1", "s", "ann"), ("2", "2", "ann"), ("3", "9", "ann"), ("4", "x", "ann"),
        ("4", " 3 ", "ann"), ("5", "2", "ann"), ("5", "S", "bob"), ("6", "01", "ann"), ("nobody", "1", "ann"),
    )
    got = {r["source_id"]: r for r in apply_reviews(labelled, decisions, SENTIMENT).collect()}
    assert len(got) == 8
    seen = {i for i, r in got.items() if r["is_human_reviewed"]}
    assert seen == {"0", "1", "2", "4", "5"}
    assert [got[i]["final_label"] for i in "012345"] == [
        "Positive", "Positive", "Negative", "Positive", "Neutral", "Positive",
    ]
    assert {i for i, r in got.items() if r["human_override"]} == {"2", "4"}
    assert got["5"]["annotator"] == "bob" and got["7"]["annotator"] == "auto"
    assert got["0"]["annotation_time_sec"] == 1.5 and got["7"]["annotation_time_sec"] == 0.0
    counts = review_counts(apply_reviews(labelled, decisions, SENTIMENT)).first()
    assert tuple(counts) == (8, 3, 5, 2, 40.0)


def test_quit_ends_a_session(spark):
    decisions = decide(
        spark, ("0", "1", "ann"), ("1", "q", "ann"), ("2", "1", "ann"), ("3", "1", "bob"), ("4", "q", "ann"),
        ("5", "2", None), ("6", "Q", None), ("7", "2", None),
    )
    got = {r["source_id"] for r in effective_decisions(decisions, SENTIMENT.labels).collect()}
    assert got == {"0", "3", "5"}


def test_small_decisions_leave_the_texts_in_place(spark, texts, tmp_path):
    labelled = label(texts("love", "hate"), SENTIMENT, "_text")
    decide(spark, ("0", "2", "ann")).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    plan = apply_reviews(labelled, stored, SENTIMENT)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = apply_reviews(labelled, stored, SENTIMENT)
        assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()
        assert {r["source_id"]: r["final_label"] for r in large.collect()} == {"0": "Negative", "1": "Negative"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_review_queue_is_ordered(texts):
    labelled = label(texts("zzz", "love", "okay", "qqq"), SENTIMENT, "_text")
    got = [(r["_id"], r["auto_confidence"]) for r in review_queue(labelled).collect()]
    assert got == [("0", 0.0), ("3", 0.0), ("1", 0.1429)]


def test_stream_gives_the_batch_labels(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["love", "awful", "okay", "zzz", " "] * 20)]
    df = spark.createDataFrame(rows, "id int, text string")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = label_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), SENTIMENT)
    run = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    columns = ["id", "auto_label", "auto_confidence"]
    got = sorted(spark.read.parquet(str(tmp_path / "out")).select(columns).collect())
    assert got == sorted(label(df, SENTIMENT).select(columns).collect())


def test_windowed_counts_in_batch(spark):
    rows = [("2024-01-01 00:10:00", "A"), ("2024-01-01 00:50:00", "A"), ("2024-01-01 01:00:00", "B")]
    df = spark.createDataFrame(rows, "ts string, auto_label string").withColumn("ts", F.to_timestamp("ts"))
    got = windowed_label_counts(df, "ts").select(F.hour("window_start"), "label", "n").collect()
    assert sorted(map(tuple, got)) == [(0, "A", 2), (1, "B", 1)]


def test_single_label_rule_set(texts):
    only = RuleSet("t", {"Only": [r"\bx\b"]})
    got = [(r["auto_label"], r["auto_confidence"]) for r in label(texts("x", "y", " "), only, "_text").orderBy("_id").collect()]
    assert got == [("Only", 1.0), ("Only", 0.0), ("Unknown", 0.0)]


def test_windows_of_all_batches_add_up(spark, tmp_path):
    from marginalia.streaming.label_stream import count_windows, window_totals

    rows = [(f"2024-01-01 {h:02d}:30:00", "a") for h in (1, 1, 2, 9)] + [("2024-01-01 00:10:00", "b")]
    schema = "ts timestamp, auto_label string"
    table = spark.createDataFrame(rows, "ts string, auto_label string").selectExpr("to_timestamp(ts) AS ts", "auto_label")
    for part in (table.filter("auto_label = 'a'"), table.filter("auto_label = 'b'")):
        part.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        count_windows(stream, f"{tmp_path}/counts", f"{tmp_path}/progress", "ts").awaitTermination()
    got = {(r.window_start.hour, r.label): r.n for r in window_totals(spark, f"{tmp_path}/counts").collect()}
    assert got == {(1, "a"): 2, (2, "a"): 1, (9, "a"): 1, (0, "b"): 1}

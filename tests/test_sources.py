import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginalia.operators.labelling import label
from marginalia.operators.records import label_batch
from marginalia.operators.summary import annotation_summary
from marginalia.plans import catalog, label_job
from marginalia.sources import annotated, paths, readers, reviewtool, rules, samples, splitcsv, writers
from marginalia.sources.vocabulary import BUILT_IN_RULES, SAMPLE_TEXTS, SHOP_RULES


def put(path, body):
    path.write_text(body, encoding="utf-8", newline="")
    return str(path)


def pairs(df):
    return sorted((r["_id"], r["_text"]) for r in df.collect())


def test_csv_with_quotes_breaks_and_blanks(spark, tmp_path):
    body = 'id,text\n1,"He said ""hi""\nand left"\n2,\n3,   \n4,"a, b"\n5, padded\t\n'
    got = pairs(readers.load(spark, put(tmp_path / "a.csv", body)))
    assert got == [("1", 'He said "hi"\nand left'), ("4", "a, b"), ("5", "padded")]


def test_csv_without_breaks_can_be_read_splittable(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id,text\n1,one\n2,two\n")
    assert readers.scan_csv(spark, path, multi_line=False).count() == 2


def test_tsv_json_and_jsonl(spark, tmp_path):
    assert pairs(readers.load(spark, put(tmp_path / "a.tsv", "id\ttext\n1\tx y\n"))) == [("1", "x y")]
    records = [{"id": 1, "content": "Product is great"}, {"id": "2", "content": None}, {"id": 3, "content": 4.5}]
    got = pairs(readers.load(spark, put(tmp_path / "a.json", json.dumps(records))))
    assert got == [("1", "Product is great"), ("3", "4.5")]
    lines = "\n".join(json.dumps(r) for r in records)
    for name in ("a.jsonl", "b.NDJSON"):
        assert pairs(readers.load(spark, put(tmp_path / name, lines))) == got


def test_missing_and_unsupported_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load(spark, str(tmp_path / "nowhere.csv"))
    with pytest.raises(ValueError):
        readers.load(spark, put(tmp_path / "a.xlsx", "x"))


def test_column_detection():
    assert readers.detect_text_column(["Body", "TITLE", "x"]) == "TITLE"
    assert readers.detect_id_column(["ITEM_ID", "Id"]) == "Id"
    assert readers.detect_id_column(["key"]) is None
    assert readers.detect_text_column(["x", "text"], "x") == "x"
    with pytest.raises(KeyError):
        readers.detect_text_column(["Text"], "text")
    with pytest.raises(KeyError):
        readers.detect_text_column(["x"])
    with pytest.raises(KeyError):
        readers.detect_id_column(["ID"], "id")


def test_generated_ids_keep_gaps_and_limit_counts_kept_rows(spark, tmp_path):
    body = "text,n\n" + "".join(f"{'  ' if i % 3 == 1 else f'row {i}'},{i}\n" for i in range(100))
    path = put(tmp_path / "a.csv", body)
    got = readers.load(spark, path).collect()
    assert sorted(int(r["_id"]) for r in got) == [i for i in range(100) if i % 3 != 1]
    assert all(r["_id"] == r["n"] for r in got)
    first = readers.load(spark, path, limit=20).collect()
    assert sorted(int(r["n"]) for r in first) == [i for i in range(100) if i % 3 != 1][:20]
    assert readers.load(spark, path, limit=0).count() == len(got)


def test_ids_follow_file_order_over_many_splits(spark, tmp_path):
    spark.range(5000).select(F.concat(F.lit("t"), "id").alias("text")).coalesce(1).write.text(str(tmp_path / "a"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = spark.read.text(str(tmp_path / "a")).withColumnRenamed("value", "text")
        assert raw.rdd.getNumPartitions() > 4
        got = readers.clean(raw).collect()
        limited = readers.clean(raw, limit=1234).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 5000 and all(r["_text"] == f"t{r['_id']}" for r in got)
    assert sorted(int(r["_id"]) for r in limited) == list(range(1234))


def test_rule_files(spark, tmp_path):
    path = put(tmp_path / "r.json", json.dumps({"_note": "x", "B": ["b+"], "A": ["a", "c"]}))
    assert rules.scan_rules(spark, path) == {"B": ["b+"], "A": ["a", "c"]}
    assert list(rules.scan_rules(spark, path)) == ["B", "A"]
    with pytest.raises(ValueError):
        rules.scan_rules(spark, put(tmp_path / "list.json", "[1]"))
    with pytest.raises(FileNotFoundError):
        rules.scan_rules(spark, str(tmp_path / "none.json"))


def test_samples_cycle_with_suffix(spark):
    rows = samples.generate_samples(spark, "intent", 40).collect()
    assert [r["id"] for r in rows][:2] == ["intent_0001", "intent_0002"] and len(rows) == 40
    assert rows[14]["text"] == SAMPLE_TEXTS["intent"][14]
    assert rows[15]["text"] == SAMPLE_TEXTS["intent"][0] + " (sample #16)"
    assert samples.generate_samples(spark, "other", 1).first()["text"] == SAMPLE_TEXTS["sentiment"][0]
    assert samples.generate_samples(spark, "x", 10000).agg(F.max("id")).first()[0] == "x_9999"


def test_gold_items(spark):
    for task in BUILT_IN_RULES:
        rows = samples.gold_items(spark, task).collect()
        assert len(rows) == 10 and {r["final_label"] for r in rows} <= set(BUILT_IN_RULES[task])
    assert samples.gold_items(spark, "other").first()["final_label"] == "Positive"


# Recorded results of labelling the generated samples.
RECORDED = [
    ("sentiment", None, 50, {"Positive": 28, "Negative": 18, "Neutral": 4}, (0.2388, 0.25, 0.125, 0.4286, 0.0), 22),
    ("sentiment", None, 20, {"Positive": 10, "Negative": 8, "Neutral": 2}, (0.2494, 0.2679, 0.125, 0.4286, 0.0), 8),
    ("intent", None, 15, {"Informational": 5, "Transactional": 5, "Navigational": 3, "Conversational": 2},
     (0.5111, 0.3333, 0.3333, 1.0, 0.0), 0),
    ("content_category", None, 10, {"Spam": 3, "Safe": 7}, (0.13, 0.0, 0.0, 0.5, 60.0), 6),
    ("custom", SHOP_RULES, 10, {"Product Inquiry": 3, "Post-Purchase Review": 3, "Complaint or Return": 1,
     "General Comment": 3}, (0.3, 0.3333, 0.0, 0.6667, 30.0), 3),
]


@pytest.mark.parametrize("task,custom,n,labels,stats,needs_review", RECORDED)
def test_recorded_summaries(spark, task, custom, n, labels, stats, needs_review):
    source = "sentiment" if task == "custom" else task
    cleaned = readers.clean(samples.generate_samples(spark, source, n))
    got = annotation_summary(label_batch(cleaned, rules.resolve_rules(task, custom))).first()
    assert got["label_distribution"] == labels == got["auto_label_distribution"]
    assert tuple(got["confidence_stats"]) == stats
    assert got["total_records"] == n and got["task"] == task
    assert got["quality_flags"]["needs_human_review"] == needs_review
    assert tuple(got["human_review"]) == (0, 0, 0.0)


def test_summary_of_nothing(spark):
    empty = label_batch(spark.createDataFrame([], "_id string, _text string"), rules.resolve_rules("intent"))
    got = annotation_summary(empty).first()
    assert got["total_records"] == 0 and got["label_distribution"] == {}
    assert tuple(got["confidence_stats"]) == (0.0,) * 5 and got["human_review"]["override_rate_pct"] == 0.0


def test_annotated_aliases_and_coercion(spark, tmp_path):
    body = (
        " Review ,LABEL,prediction,Confidence,is_human_reviewed,human_override\n"
        "good,Positive,Positive,0.5,True,False\nbad,Negative,Neutral,oops,1,\n,x,y,nan,true,yes\n"
    )
    rows = annotated.scan_annotated(spark, put(tmp_path / "a.csv", body)).collect()
    assert [(r["text"], r["final_label"], r["auto_confidence"], r["is_human_reviewed"], r["human_override"]) for r in rows] == [
        ("good", "Positive", 0.5, True, False), ("bad", "Negative", 0.0, True, False), ("", "x", 0.0, True, False),
    ]
    with pytest.raises(KeyError, match="auto_label"):
        annotated.scan_annotated(spark, put(tmp_path / "b.csv", "text,final_label\nx,y\n"))
    with pytest.raises(FileNotFoundError):
        annotated.scan_annotated(spark, str(tmp_path / "c.csv"))
    gold = annotated.scan_gold(spark, put(tmp_path / "g.csv", "source_id,text,final_label\ng1,t,Spam\n"))
    assert gold.first()["final_label"] == "Spam"


def test_alias_only_when_canonical_is_absent(spark):
    df = spark.createDataFrame([("a", "b", "c")], "text string, content string, review string")
    assert annotated.alias_columns(df).columns == ["text", "content", "review"]
    assert annotated.alias_columns(df.drop("text")).columns == ["text", "review"]


NASTY = ['plain', 'say "hi", ok', "two\nlines", "tab\there", " kept? ", "back\\slash", "ünï 😊", "a\r\nb", "'q'"]


def test_sinks_round_trip(spark, texts, tmp_path):
    rule_set = rules.resolve_rules("sentiment")
    records = label_batch(texts(*NASTY), rule_set)
    paths = writers.export(spark, records, str(tmp_path / "out"), rule_set, "all")
    assert set(paths) == {"records", "csv", "jsonl", "review_tasks", "summary"}
    flat = annotated.scan_annotated(spark, paths["csv"])
    assert flat.columns[-3:] == ["signal_positive", "signal_negative", "signal_neutral"]
    assert sorted(r["text"] for r in flat.collect()) == sorted(NASTY)
    assert {r["is_human_reviewed"] for r in flat.collect()} == {False}
    nested = spark.read.json(paths["jsonl"])
    assert sorted(r["text"] for r in nested.collect()) == sorted(NASTY)
    assert nested.select("auto_signals.Positive").count() == len(NASTY)
    back = reviewtool.import_review_tasks(spark, paths["review_tasks"], multi_line=True).collect()
    assert sorted(r["text"] for r in back) == sorted(NASTY) and not any(r["human_override"] for r in back)
    ids = {r["record_id"] for r in spark.read.parquet(paths["records"]).collect()}
    assert ids == {r["record_id"] for r in flat.collect()} == {r["record_id"] for r in nested.collect()}
    assert spark.read.json(paths["summary"]).first()["total_records"] == len(NASTY)
    less = writers.export(spark, records, str(tmp_path / "less"), rule_set, "csv")
    assert "review_tasks" not in less and "jsonl" in less and "summary" in less


def test_csv_sink_of_blank_texts(spark, tmp_path):
    """They have no signals; their empty cells were cast to numbers, which is an error."""
    rows = [(0, "the cat and the dog", "en", "a", 19), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n", "en", "a", 2)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = catalog.registered()["K1_sink_csv"](spark, str(tmp_path)).orderBy("source_id").collect()
    signals = [[r[f"signal_{x}"] for x in catalog.LANGUAGE.labels] for r in rows]
    assert sum(signals[0]) > 0 and signals[1:] == [[None] * len(signals[0])] * 3
    assert [(r["auto_label"], r["auto_confidence"]) for r in rows[1:]] == [("Unknown", 0.0)] * 3


def test_review_task_document(spark, texts):
    task = writers.review_tasks(label_batch(texts("love it"), rules.resolve_rules("sentiment")), "sentiment")
    doc = json.loads(task.select(F.to_json(F.struct("*"))).first()[0])
    assert set(doc) == {"id", "data", "annotations", "predictions"}
    assert doc["data"] == {"text": "love it", "source_id": "0", "task_type": "sentiment"}
    result = doc["annotations"][0]["result"][0]
    assert result["value"] == {"choices": ["Positive"], "confidence": 0.1429}
    assert (result["from_name"], result["to_name"], result["type"]) == ("label", "text", "choices")
    assert doc["predictions"][0]["model_version"] == "rule_engine_v1.0.0"


def test_split_csv_hands_on_long_records_in_small_batches():
    """A batch of 30 MB, with records of one line and of three; before, they were handed on at once."""
    line = "x" * 100_000
    turns = [splitcsv._KEEPS if i % 4 == 0 else (1 if i % 4 in (1, 3) else splitcsv._KEEPS) for i in range(300)]
    columns = {"__file": ["f"] * 300, "__block": [0] * 300, "turns": turns, "value": [f"{i}{line}" for i in range(300)], "owner": [None] * 300}
    batch = pa.RecordBatch.from_pydict(columns | {"owner": pa.array([None] * 300, pa.int64())})
    got = list(splitcsv._assemble(iter([batch])))
    assert max(b.nbytes for b in got) < 3 * splitcsv._PIECE
    records = [r for b in got for r in b.column("record").to_pylist()]
    assert [r.count("x") // 100_000 for r in records] == [1, 3] * 75
    assert "\n".join(records) == "\n".join(columns["value"])


def test_json_array_files_are_arrays(spark, tmp_path):
    df = spark.range(10).repartition(3).select("id", F.lit(None).cast("string").alias("gone"))
    path = writers.write_json_array(df, str(tmp_path / "a.json"))
    loaded = [json.loads(p.read_text()) for p in (tmp_path / "a.json").glob("part-*")]
    assert sorted(r["id"] for part in loaded for r in part) == list(range(10))
    assert readers.scan_json_array(spark, path).count() == 10


def test_json_arrays_of_many_batches_and_none(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        # Nothing in the first partition, one row, exactly a batch, and several batches.
        df = spark.range(0, 40, 1, 4).filter("id >= 19 and id not between 23 and 26 and id <> 20").repartitionByRange(4, "id")
        path = writers.write_json_array(df, str(tmp_path / "a.json"))
        empty = writers.write_json_array(spark.range(0, 8, 1, 2).filter("id < 4"), str(tmp_path / "b.json"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for folder, ids in ((path, [19, 21, 22, *range(27, 40)]), (empty, range(4))):
        loaded = [json.loads(p.read_text()) for p in sorted(Path(folder).glob("part-*"))]
        assert [r["id"] for part in loaded for r in part] == list(ids)
    assert loaded[-1] == []


def test_json_arrays_pass_batches_through(spark):
    """Python makes no copy of a batch and keeps none."""
    batches = [pa.RecordBatch.from_pydict({"value": pa.array(x, pa.large_string())}) for x in (['[{"a":1}', ',{"a":2}'], [], [',{"a":3}'])]
    got = list(writers._closer()(iter(batches)))
    assert got[0] is batches[0] and got[1] is batches[2] and got[2].to_pydict() == {"value": ["]"]}
    assert got[2].schema == batches[0].schema
    assert [b.to_pydict() for b in writers._closer()(iter([]))] == [{"value": ["[]"]}]


def test_corrected_tasks_come_back(spark, tmp_path):
    doc = {
        "id": 7,
        "data": {"text": "meh", "source_id": "s7", "task_type": "sentiment"},
        "annotations": [
            {"id": 1, "result": [{"type": "choices", "value": {"choices": ["Neutral"]}}], "was_cancelled": False, "lead_time": 2.5},
            {"id": 2, "result": [], "was_cancelled": True},
        ],
        "predictions": [{"score": 0.4, "result": [{"type": "choices", "value": {"choices": ["Positive"]}}]}],
    }
    rows = reviewtool.import_review_tasks(spark, put(tmp_path / "t.json", json.dumps(doc))).collect()
    assert len(rows) == 1
    assert (rows[0]["source_id"], rows[0]["final_label"], rows[0]["auto_label"], rows[0]["human_override"]) == (
        "s7", "Neutral", "Positive", True,
    )


def test_jobs_end_to_end(spark, tmp_path):
    lines = "\n".join(json.dumps({"id": i, "text": t}) for i, t in enumerate(SAMPLE_TEXTS["sentiment"]))
    source = put(tmp_path / "in.jsonl", lines)
    rules_path = put(tmp_path / "rules.json", json.dumps(SHOP_RULES))
    out = label_job.label_file(spark, source, "custom", str(tmp_path / "a"), rules_path=rules_path, limit=10)
    assert spark.read.parquet(out["records"]).count() == 10
    decisions = spark.createDataFrame(
        [("0", "2", "ann", 1.5, 1), ("1", "", "ann", 1.0, 2)],
        "source_id string, choice string, annotator string, time_sec double, seq long",
    )
    out = label_job.label_file(spark, source, "sentiment", str(tmp_path / "b"), decisions=decisions, mode="ls")
    gold = put(tmp_path / "gold.csv", "source_id,final_label\n0,Positive\n1,Negative\n")
    checks = label_job.check_file(spark, out["csv"], str(tmp_path / "qa"), gold_path=gold, other_path=out["csv"])
    assert [r["check"] for r in checks.orderBy("ord").collect()][-2:] == [
        "Golden Set Validation", "Inter-Annotator Agreement",
    ]
    assert spark.read.json(str(tmp_path / "qa" / "checks")).count() == 8
    row = label_job.compare_annotators(spark, out["csv"], out["csv"]).first()
    assert row["cohens_kappa"] == 1.0 and row["exact_agreement_pct"] == 100.0


class _Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = {"spark." + k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self._settings.get(key, default)


def test_a_cluster_without_shared_storage_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        paths.shared_folder(_Session(master="spark://host:7077"), "x")
    assert paths.shared_folder(_Session(master="yarn", checkpoint_dir="hdfs://x/shared"), "x").startswith("hdfs://x/shared/")
    assert paths.shared_folder(_Session(master="local[2]"), "x")


def test_review_tasks_as_one_array(spark, tmp_path):
    task = {"id": "t", "data": {"text": "x", "source_id": "s"}, "annotations": [{"id": "a", "result": []}], "predictions": []}
    (tmp_path / "array.json").write_text(json.dumps([task] * 3, indent=2))
    path = str(tmp_path / "array.json")
    assert reviewtool.import_review_tasks(spark, path, multi_line=True).count() == 3
    with pytest.raises(Exception, match="multi_line=True"):
        reviewtool.import_review_tasks(spark, path).collect()


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,one\n")
    (tmp_path / "b.csv").write_text("text,id\ntwo,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.scan(spark, str(tmp_path), format="csv", multi_line=False).collect()


def test_rows_off_a_shuffle_are_not_numbered(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text\n" + "x\n" * 50)
    rows = readers.scan(spark, str(tmp_path / "a.csv"))
    assert readers.clean(rows).count() == 50
    with pytest.raises(Exception, match="straight off a reader"):
        readers.clean(rows.repartition(4)).collect()


def test_folders_and_schemas_through_load(spark, tmp_path):
    spark.createDataFrame([("a", "one"), ("b", "two")], "id string, text string").write.json(str(tmp_path / "out"))
    rows = readers.load(spark, str(tmp_path / "out"), format="jsonl", schema="id string, text string")
    assert sorted((r["_id"], r["_text"]) for r in rows.collect()) == [("a", "one"), ("b", "two")]

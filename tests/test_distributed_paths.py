"""Split CSV files, prefix totals, medians by selection, boilerplate and near duplicates."""

import csv
import io
import json
import os
import random
import re
import statistics
import struct
import subprocess
import sys
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marginalia.functions.bloom import bloom_filter, may_contain
from marginalia.functions.text import normalise
from marginalia.operators import boilerplate, distribution, history, near_duplicates, prefix
from marginalia.operators.median import exact_median, from_bits, ordered_bits
from marginalia.plans import label_job
from marginalia.sources import readers, splitcsv


@pytest.fixture
def small_splits(spark):
    """File splits of a few hundred bytes."""
    settings = {"files.maxPartitionBytes": "300b", "files.openCostInBytes": "0", "files.minPartitionNum": "1"}
    old = {k: spark.conf.get(f"spark.sql.{k}", None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.{k}", v)
    yield
    for k, v in old.items():
        spark.conf.unset(f"spark.sql.{k}") if v is None else spark.conf.set(f"spark.sql.{k}", v)


# --- CSV --------------------------------------------------------------------------------


def messy_csv(rng, name, n, sep, newline, header=("id", "text", "label")):
    lines = [sep.join(header)]
    # A carriage return of its own has no meaning in files whose lines end with one.
    odd = "\r" if newline == "\n" else "z"
    for i in range(n):
        text = "".join(rng.choices(["a", "b c", '""', sep, "\n", "\n\n", "é", " ", "😀", odd], k=rng.randrange(14)))
        bare = re.sub('["\n\r' + sep + "]", "", text)
        cell = rng.choice([f'"{text}"', f'"{text}"', f'"{text}"', bare, '5" pipe', f"{bare} \"odd", '""', "", f'"{text}" '])
        lines.append(sep.join([f"{name}-{i}", cell, rng.choice(["x", "", '"q"', '"two\nlines"'])]))
    return newline.join(lines) + rng.choice([newline, "", newline * 2])


@pytest.mark.parametrize(("sep", "newline", "seed"), [(",", "\n", 1), (",", "\r\n", 2), ("\t", "\n", 3), (",", "\n", 4)])
def test_split_files_equal_whole_files(spark, tmp_path, small_splits, sep, newline, seed):
    rng = random.Random(seed)
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text(messy_csv(rng, k, 120, sep, newline), "utf-8", newline="")
    whole = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=True).csv(str(tmp_path))
    rows = splitcsv.read_split_csv(spark, str(tmp_path), whole.columns, sep)
    assert splitcsv._lines(spark, str(tmp_path), sep).rdd.getNumPartitions() > 20
    assert Counter(map(tuple, rows.select(*whole.columns).collect())) == Counter(map(tuple, whole.collect()))
    in_order = [r["id"] for r in rows.orderBy(*readers.ORIGIN).collect()]
    assert in_order == [f"{k}-{i}" for k in range(3) for i in range(120)]


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    giant = "\n".join(f'line {i}, ""quoted""' for i in range(2000))
    body = f'id,text\n1,"{giant}"\n2,plain\n3,"{giant}"\n'
    path = tmp_path / "a.csv"
    path.write_text(body, "utf-8", newline="")
    got = {r["_id"]: r["_text"] for r in readers.load(spark, str(path)).collect()}
    expected = {r["id"]: r["text"] for r in csv.DictReader(io.StringIO(body))}
    assert got == expected


def test_numbers_and_limits_do_not_depend_on_splits(spark, tmp_path, small_splits):
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text("text,label\n" + "".join(f'"row {k} {i}\n\n x",l\n"  ",l\n' for i in range(90)), "utf-8", newline="")
    split = [(r["_id"], r["_text"]) for r in readers.load(spark, str(tmp_path), format="csv").collect()]
    first = [(r["_id"], r["_text"]) for r in readers.load(spark, str(tmp_path), format="csv", limit=100).collect()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert sorted((r["_id"], r["_text"]) for r in readers.load(spark, str(tmp_path), format="csv").collect()) == sorted(split)
    in_order = [(str(180 * k + 2 * i), f"row {k} {i}\n\n x") for k in range(3) for i in range(90)]
    assert sorted(split) == sorted(in_order) and sorted(first) == sorted(in_order[:100])


def test_files_with_other_headers_are_refused(spark, tmp_path, small_splits):
    for name, header in (("a", "id,text"), ("b", "id,label")):
        (tmp_path / f"{name}.csv").write_text(header + "\n" + "1,x\n" * 200, "utf-8")
    with pytest.raises(Exception, match="header differs"):
        readers.scan_csv(spark, str(tmp_path)).collect()


READ_WITHOUT_PACKAGE = """
import sys

sys.path.insert(0, sys.argv[1])  # of the driver alone
from pyspark.sql import SparkSession
from marginalia.sources import readers

settings = {"spark.ui.enabled": "false", "spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0"}
spark = SparkSession.builder.master("local[2]").config(map=settings).getOrCreate()
print("ROWS", sorted(int(r["id"]) for r in readers.scan_csv(spark, sys.argv[2]).collect() if r["text"] == "two\\nlines"))
spark.stop()
"""


def test_split_files_are_read_where_workers_lack_the_package(tmp_path):
    """Executors of a cluster have neither the driver's folder nor its path."""
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"two\nlines"\n' for i in range(100)), "utf-8", newline="")
    root = Path(__file__).resolve().parents[1]
    inherited = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != root]
    ran = subprocess.run(
        [sys.executable, "-c", READ_WITHOUT_PACKAGE, str(root), str(tmp_path / "a.csv")],
        cwd=tmp_path, env=os.environ | {"PYTHONPATH": os.pathsep.join(inherited)}, capture_output=True, text=True, timeout=300,
    )
    assert f"ROWS {list(range(100))}" in ran.stdout, ran.stderr[-2000:]


def test_a_limit_opens_only_the_files_it_needs(spark, tmp_path):
    spark.range(4000).select(F.col("id").cast("string").alias("id"), F.lit("some text").alias("text")).repartitionByRange(
        16, F.col("id").cast("long")
    ).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = readers.clean(table, limit=100)
    assert got.count() == 100
    few = readers._first_files(table, F.lit(True), 100)
    assert few.select(F.input_file_name()).distinct().count() == 1
    assert readers._first_files(table, F.lit(True), 5000).count() == 4000
    odd = table.select("id", "text").filter("id is not null")
    assert sorted(int(r["_id"]) for r in readers.clean(odd, limit=300).collect()) == list(range(300))


def test_jobs_take_reader_options_and_keep_runs_apart(spark, tmp_path):
    rows = [{"id": i, "text": "love it, great" if i % 2 else "awful, hate it"} for i in range(6)]
    source = tmp_path / "texts"
    spark.createDataFrame(rows).write.json(str(source))
    how = {"format": "jsonl", "schema": "id string, text string"}
    outs = [
        label_job.label_file(spark, str(source), "sentiment", str(tmp_path / "out"), mode="all", review_below=0.9, **how)
        for _ in range(2)
    ]
    named = label_job.label_file(spark, str(source), "sentiment", str(tmp_path / "out"), run_id="mine", **how)
    assert len({*(o["csv"] for o in outs), named["csv"]}) == 3 and "task=sentiment/run=mine" in named["csv"]
    queue = [json.loads(x.value) for x in spark.read.text(outs[0]["review_queue"]).collect()]
    assert len(queue) == 6 and {q["task"] for q in queue} == {"sentiment"}
    arrays = [json.loads(x) for x in (r[0] for r in spark.read.text(outs[0]["review_tasks"], wholetext=True).collect())]
    assert sum(map(len, arrays)) == 6 and all(isinstance(a, list) for a in arrays)
    with pytest.raises(Exception, match="already exists"):
        label_job.label_file(spark, str(source), "sentiment", str(tmp_path / "out"), run_id="mine", **how)
    checks = label_job.check_file(spark, named["csv"], str(tmp_path / "qa"), other_path=outs[0]["csv"], format="csv", multi_line=False)
    assert checks.count() == 7
    both = label_job.compare_annotators(spark, named["csv"], outs[0]["csv"], multi_line=False)
    assert both.first()["exact_agreement_pct"] == 100.0


# --- totals and medians -----------------------------------------------------------------


def test_totals_before(spark):
    rng = random.Random(4)
    rows = [(f"f{i % 7}", i, rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(rows, "f string, b long, n long").repartition(6)
    got = prefix.with_totals_before(prefix.by_range(df, ["f", "b"], "t"), ["f", "b"], "n", "before").collect()
    total, expected = 0, {}
    for f, b, n in sorted(rows):
        expected[f, b] = total
        total += n
    assert {(r["f"], r["b"]): r["before"] for r in got} == expected


def test_bits_of_doubles_keep_their_order(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
    values += [float("inf"), float("-inf"), 1.0, 0.9999999999999999, 1.0000000000000002, 2.0, 1024.0, 0.1]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    bits = ordered_bits(F.col("v"))
    for v, b, back in spark.createDataFrame([(v,) for v in values], "v double").select("v", bits, from_bits(bits)).collect():
        size = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert (b, back) == (-size if v < 0 else size, v)


def test_medians_of_close_and_weighted_values(spark):
    close = spark.range(0, 100_000, 1, 8).select((0.5 + F.col("id") * 2.0**-53).alias("v"))
    # Distances of 2^-53 are those of neighbouring doubles here.
    assert exact_median(close, "v").first()["median"] == statistics.median(0.5 + i * 2.0**-53 for i in range(100_000))
    rows = [(0.25, 3), (0.5, 1), (None, 9), (float("nan"), 9), (1.0, 2)]
    df = spark.createDataFrame(rows, "v double, w long")
    assert exact_median(df, "v", "w").first()["median"] == 0.375
    assert exact_median(df.filter("w = 9"), "v").first()["median"] is None


def test_gini_of_many_classes(spark):
    rng = random.Random(8)
    sizes = [rng.randrange(1, 40) for _ in range(900)]
    df = spark.createDataFrame([(f"c{i}",) for i, n in enumerate(sizes) for _ in range(n)], "final_label string")
    row = distribution.check_label_distribution(df).first()
    total, k = sum(sizes), len(sizes)
    gini = (2 * sum(r * n for r, n in enumerate(sorted(sizes), 1)) / total - (k + 1)) / k
    assert row["n_classes"] == k and row["gini_coefficient"] == round(gini, 4)
    plan = distribution.distribution_totals(df)._jdf.queryExecution().executedPlan().toString()
    # The only window in one task runs over the totals of ranges.
    assert len(re.findall(r"Exchange SinglePartition", plan)) <= 2 + len(re.findall(r"agg|Aggregate", plan))


# --- lines and near duplicates ------------------------------------------------------------


def test_bloom_filter(spark):
    keys = spark.range(0, 5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    words = bloom_filter(keys, "k", 5000)
    asked = spark.range(0, 50_000).select("id", may_contain(words, F.md5(F.col("id").cast("string")), 5000).alias("in"))
    yes = [r["id"] for r in asked.filter("in").collect()]
    assert set(range(5000)) <= set(yes) and len(yes) < 5000 + 0.05 * 45_000
    assert bloom_filter(keys, "k", 10**9) is None


def plain_lines(text):
    lines = [" ".join(x.lower().split()) for x in (text or "").split("\n")]
    return [(i, x) for i, x in enumerate(lines) if x]


def test_boilerplate_against_plain_python(spark):
    rng = random.Random(6)
    common, rare = ["Share this", "all rights  Reserved", "Home"], [f"line {i}" for i in range(4000)]
    rows = [(i, "\n".join(rng.choice([rng.choice(common), rng.choice(rare), " ", "", "HOME\t"]) for _ in range(rng.randrange(15)))) for i in range(300)]
    # One line in a third of everything, repeated inside texts too.
    rows += [(i, "hot line\n\nhot LINE\nown " + str(i)) for i in range(300, 450)] + [(900, None), (901, ""), (902, " \n\t")]
    df = spark.createDataFrame(rows, "source_id long, text string").repartition(5)
    held = Counter(x for _, t in rows for x in {x for _, x in plain_lines(t)})
    expected, runs = {}, []
    for i, t in rows:
        lines = plain_lines(t)
        flags = [held[x] >= 10 for _, x in lines]
        mine = []
        for nth, flag in enumerate(flags):
            if flag and nth and flags[nth - 1]:
                mine[-1][2], mine[-1][3] = lines[nth][0], mine[-1][3] + 1
            elif flag:
                mine.append([i, lines[nth][0], lines[nth][0], 1])
        runs += map(tuple, mine)
        expected[i] = (len(lines), sum(flags), len(mine), max((m[3] for m in mine), default=0))
    got = boilerplate.boilerplate_shares(df).collect()
    assert {r["id"]: (r["n_lines"], r["n_flagged"], r["n_runs"], r["longest_run"]) for r in got} == expected
    found = boilerplate.boilerplate_runs(boilerplate.flagged_lines(df))
    assert sorted(tuple(r) for r in found.select("id", "start_line", "end_line", "n_lines").collect()) == sorted(runs)
    check = boilerplate.check_boilerplate(df).first()
    assert not check["passed"] and check["mostly_boilerplate"] >= 150
    assert boilerplate.check_boilerplate(df.limit(0)).first()["skipped"]


def test_no_text_is_shuffled_for_boilerplate(spark):
    df = spark.createDataFrame([(1, "a\nb")], "source_id long, text string")
    plan = boilerplate.frequent_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 3, 5, 6, 9, 30, 60, 61]))
        for _ in range(rng.choice([1, 1, 3])):
            edited = list(words)
            for _ in range(rng.randrange(3)):
                if edited:
                    edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "  ", "\n"]).join(edited).upper() if rng.random() < 0.2 else " ".join(edited)))
    # A large group of copies, of edited copies, and words everybody uses.
    base = rng.choices(vocabulary, k=80)
    rows += [(1000 + i, " ".join(base)) for i in range(60)]
    rows += [(2000 + i, " ".join([*base[:40], f"edit{i}", *base[41:]])) for i in range(40)]
    rows += [(5000, None), (5001, ""), (5002, " ")]
    keys = {i: " ".join((t or "").lower().split()) for i, t in rows}

    def grams(key, w=5):
        words = key.split()
        return {tuple(words[j : j + w]) for j in range(max(1, len(words) - w + 1))} if words else set()

    sets = {k: grams(k) for k in set(keys.values())}
    near = Counter()
    pairs = set()
    least = {k: min(i for i, x in keys.items() if x == k) for k in sets}
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            near[a] += 1
            near[b] += 1
            pairs.add((*sorted((least[a], least[b])), both, len(sets[a] | sets[b])))
    copies = Counter(keys.values())
    df = spark.createDataFrame(rows, "source_id long, text string").repartition(5)
    got = {tuple(r) for r in near_duplicates.near_duplicates(df).select("id", "class_id", "copies", "n_shingles", "n_near").collect()}
    assert got == {(i, least[k], copies[k], len(sets[k]), near[k]) for i, k in keys.items()}
    assert {tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()} == pairs
    assert not near_duplicates.check_near_duplicates(df).first()["passed"]
    assert near_duplicates.check_near_duplicates(df.limit(0)).first()["skipped"]


def test_sets_of_texts_without_partners_do_not_move(spark, monkeypatch):
    """Texts with a passage in common, exact copies, and one pair of near copies: only that pair is ordered and joined."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(30)]
    own = [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(150)]
    rows = [(i, " ".join(words + passage)) for i, words in enumerate(own)]
    rows += [(500 + i, rows[7][1]) for i in range(40)] + [(900, rows[0][1].replace(own[0][100], "changed")), (None, "alone")]
    kept = {}

    def held(df, purpose, put=near_duplicates.stored):
        kept[purpose] = put(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(near_duplicates, "stored", held)
    df = spark.createDataFrame(rows, "source_id long, text string")
    got = near_duplicates.near_duplicate_pairs(df).collect()
    assert [tuple(r) for r in got] == [(0, 900, 221, 231)]
    assert kept["near-sets"].count() == 2


def test_first_look_at_other_similarities(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    sets = [{rng.choice(words) for _ in range(rng.randrange(1, 12))} for _ in range(60)]
    sets = [set(x) for x in {frozenset(x) for x in sets}]
    df = spark.createDataFrame([(i, " ".join(sorted(x))) for i, x in enumerate(sets)], "source_id long, text string")
    for percent in (5, 34, 50, 95):
        got = {(r["id_a"], r["id_b"]) for r in near_duplicates.near_duplicate_pairs(df, words=1, percent_alike=percent).collect()}
        assert got == {
            (i, j) for (i, a), (j, b) in combinations(enumerate(sets), 2) if 100 * len(a & b) >= percent * len(a | b)
        }


def test_normalised_words_have_single_spaces(spark):
    row = spark.createDataFrame([(" A  b\n\tC ",)], "t string").select(normalise(F.col("t"))).first()
    assert row[0] == "a b c"


# --- history ------------------------------------------------------------------------------


def labelled_texts(spark, *rows):
    return spark.createDataFrame(list(rows), "text string, final_label string")


def test_duplicates_among_earlier_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    history.open_index(spark, "seen_texts", path, 4)
    first = labelled_texts(spark, ("Good  day", "a"), ("good day", "a"), ("bad day", "b"), (None, "c"))
    history.add_batch(spark, "seen_texts", "one", labelled_texts(spark, ("wrong", "x")), 4)
    history.add_batch(spark, "seen_texts", "one", first, 4)  # replaces what was wrong
    history.add_batch(spark, "seen_texts", "two", labelled_texts(spark, ("bad day", "a")), 4)
    new = labelled_texts(spark, ("GOOD DAY", "b"), ("bad day", "b"), ("", "c"), ("new", "a"), ("new", "a"), ("wrong", None))
    found = history.duplicates_with_history(spark, "seen_texts", new)
    got = sorted((r["copies"], r["earlier"], r["labels"], r["conflicting"]) for r in found.collect())
    assert got == sorted([(1, 2, 2, True), (1, 2, 2, True), (1, 1, 1, False), (2, 0, 1, False), (1, 0, 0, False)])
    row = history.check_with_history(spark, "seen_texts", new).first()
    assert (row["seen_before"], row["duplicates"], row["conflicting_texts"], row["passed"]) == (3, 5, 2, False)
    # Its own former rows do not count against a batch; an empty batch leaves nothing behind.
    assert history.duplicates_with_history(spark, "seen_texts", first, "one").agg(F.sum("earlier")).first()[0] == 1
    history.add_batch(spark, "seen_texts", "two", labelled_texts(spark), 4)
    assert history.duplicates_with_history(spark, "seen_texts", first, "one").agg(F.sum("earlier")).first()[0] == 0
    # Another session finds the same index by its folder.
    history.open_index(spark, "seen_again", path, 4)
    assert spark.table("seen_again").filter("digest is not null").count() == 3
    assert history.check_with_history(spark, "seen_again", new.limit(0)).first()["skipped"]


def test_the_index_is_not_shuffled(spark, tmp_path):
    history.open_index(spark, "still_texts", str(tmp_path / "index"), 4)
    history.add_batch(spark, "still_texts", "one", labelled_texts(spark, ("a", "x"), ("b", "y")), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = history.duplicates_with_history(spark, "still_texts", labelled_texts(spark, ("a", "z")), buckets=4)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    before_join = plan[plan.index("SortMergeJoin") :]
    index_side = before_join[: before_join.index("still_texts")]
    assert "Bucketed: true" in before_join and "Exchange" not in index_side

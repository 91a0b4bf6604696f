"""Exact and near duplicates against brute force."""

import random
import re
from collections import defaultdict

import numpy as np

from marginalia.llm import exact_dedup, minhash
from marginalia.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_exact_groups(odd_docs, no_docs, odd_texts):
    groups = defaultdict(list)
    for i, text in odd_texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i))
    expected = []
    for rows in groups.values():
        keep = min(rows)[2]
        expected += [(str(i), str(keep), len(rows)) for _, _, i in rows]
    found = exact_dedup.exact_groups(odd_docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == sorted(expected)
    assert sum(r.kept for r in found) == len(groups)
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_exact_drop_keeps_columns_and_one_row_each(odd_docs, no_docs, odd_texts):
    kept = exact_dedup.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd_texts})
    assert exact_dedup.drop_duplicates(no_docs).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 580)] + [(7, 7), (2, 3), (3, 2)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == roots(nodes, [(a, b) for a, b in links if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def brute(rows, k, percent):
    """component of each row number, and set sizes, all pairs compared."""
    sets = []
    for _, text in rows:
        words = words_of(text)
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set())
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * common >= percent * (len(a) + len(b) - common):
                links.append((j, i))
    root = roots(range(len(rows)), links)
    least = {}
    for n, r in root.items():
        if rows[n][0] is not None:
            least[r] = min(least.get(r, rows[n][0]), rows[n][0])
    return [least[root[n]] if rows[n][0] is not None else None for n in range(len(rows))], [len(s) for s in sets]


def near_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) + 100, " ".join(copy)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for _ in range(30):
        own = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 20, 50])))
        rows.append((len(rows) + 100, passage + " " + own))
    rng.shuffle(rows)
    return rows


def test_near_groups_equal_all_pairs(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k in (2, 5):
        expected, sizes = brute(rows, k, 80)
        found = {r.doc_id: r for r in minhash.near_groups(docs, minhash.Rule(k, 80)).collect()}
        assert [found[i].component_id for i, _ in rows] == expected
        assert [found[i].n_shingles for i, _ in rows] == sizes
        assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_near_groups_of_odd_texts(odd_docs, no_docs, odd_texts):
    expected, sizes = brute(odd_texts, 2, 80)
    found = minhash.near_groups(odd_docs, minhash.Rule(2, 80)).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found)
    assert got == sorted((str(i), n, str(c)) for (i, _), n, c in zip(odd_texts, sizes, expected))
    assert all(r.kept for r in found if r.doc_id is None)
    kept = minhash.keep_first(odd_docs, minhash.Rule(2, 80))
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.kept}
    assert minhash.near_groups(no_docs).count() == 0


def test_words_are_hashed_alike_in_any_block(monkeypatch):
    text = ("Alpha beta\tgamma " * 50 + "x" * 300 + " end").encode()
    whole = minhash.word_hashes(text)
    monkeypatch.setattr(minhash, "HASH_BLOCK", 37)
    parts = minhash.word_hashes(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    assert whole[0][0] == minhash.word_hashes(b"aLPHA")[0][0]


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = near_rows()
    expected, _ = brute(rows, 2, 80)
    found = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Rule(2, 80)).collect()}
    assert [found[i] for i, _ in rows] == expected


def test_minhash_moves_only_texts_that_are_wanted(spark, monkeypatch):
    """Where the wanted ids are too many to broadcast, other texts are left out before the join."""
    plans = []

    def held(df, purpose, put=minhash.stored):
        if purpose == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return put(df, purpose)

    monkeypatch.setattr(minhash, "stored", held)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(60)] + [(90, " ".join([f"w0x{k}" for k in range(30)] + ["end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {i: i for i in range(60)} | {90: 0}
    assert plans and all("getbit" in p for p in plans)

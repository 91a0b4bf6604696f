"""URL rules and winnowing fingerprints against plain Python."""

import hashlib
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.llm import queries, url_filter, winnowing
from marginalia.llm.url_filter import Index, Rule, listed, split_url

RULES = queries.URL_RULES + url_filter.UNWANTED


def plain_verdict(host, path):
    fits = [
        r for r in ("org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/")
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])
    ]
    if fits:
        best = max(fits, key=len)
        return best, "allow" if best in ("org/", "com/fr/") else "block"
    words = {w.lower() for w in re.findall(r"[A-Za-z0-9]+", host + path)}
    return None, "block" if words & set(url_filter.UNWANTED_WORDS) else "allow"


HOSTS = ["example.org", "a.example.org", "notexample.org", "org", "x.com", "casino.net", "my-CASINO.net", "casinos.net", "", "com", "x.com:80", "éxample.org"]
PATHS = ["", "/", "/es/", "/es", "/ES/", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/x?casino", "/ads#x", "/a/bets/b", "/é/slots"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(HOSTS), st.sampled_from(PATHS))
def test_verdicts(host, path):
    judge = Index.build(RULES, {"example": 5, "org": 9}).matcher()
    host, path = split_url(f"https://{host}{path}")
    rule, allow, _ = judge(host, path)
    assert (rule, "allow" if allow else "block") == plain_verdict(host, path)


def test_splitting():
    assert split_url("http://A.B/C?d#e") == ("a.b", "/C")
    assert split_url("http://É.X#y") == ("É.x", "")
    assert split_url(None) == split_url("") == split_url("no scheme/x") == ("", "")
    assert split_url("a://b://c/d") == ("b:", "//c/d")


def test_rules_are_filed_under_their_rarest_closed_word():
    rules = [listed("example.org", "/en/1", False), Rule("r1", "^big^*^small^", False), Rule("r2", "ads*", False)]
    index = Index.build(rules, {"example": 100, "org": 500, "en": 3, "big": 9, "small": 2})
    assert {w: [r.text for r in rs] for w, rs in index.by_word.items()} == {"en": ["example.org/en/1"], "small": ["r1"]}
    assert [r.text for r in index.anywhere] == ["r2"]
    assert index.matcher()("leads.com", "/")[1] is False


def test_allowing_patterns_outweigh_blocking_ones():
    judge = Index.build([Rule("b", "^ads^", False), Rule("a", "||good.com^", True)], {}).matcher()
    assert judge("good.com", "/ads") == (None, True, "a") and judge("bad.com", "/ads") == (None, False, "b")


def test_judging_odd_pages(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "https://www.example.org/en/1", "x"), (None, "http://casino.net/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = sorted((str(r.page_id), r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages, RULES).collect())
    assert found == [
        ("1", "", None, "allow"), ("2", "", None, "allow"), ("2", "", None, "allow"),
        ("3", "www.example.org", "example.org/en/1", "block"), ("None", "casino.net", None, "block"),
    ]
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


M = (1 << 64) - 1


def plain_fingerprint(text):
    units = [xxhash.xxh64(u.encode(), seed=42).intdigest() for u in re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text or "")]

    def roll(run, start):
        for u in run:
            start = ((start << 1 | start >> 63) & M) ^ u
        return start

    if not units:
        return ""
    k, w = winnowing.K, winnowing.WINDOW
    grams = [roll(units, 0)] if len(units) < k else [roll(units[i + 1 : i + k], units[i]) for i in range(len(units) - k + 1)]
    grams = [xxhash.xxh64(g.to_bytes(8, "little"), seed=42).intdigest() & ((1 << winnowing.HASH_BITS) - 1) for g in grams]
    kept = {}
    for i in range(max(1, len(grams) - w + 1)):
        window = grams[i : i + w]
        at = i + max(j for j, g in enumerate(window) if g == min(window))
        kept[at] = grams[at]
    return " ".join(f"{g:x}@{at}" for at, g in sorted(kept.items()))


def test_fingerprints_equal_plain_winnowing(odd_docs, odd_texts):
    found = odd_docs.select("doc_id", winnowing.as_text(winnowing.fingerprint(F.col("text"))).alias("f")).collect()
    assert sorted((str(r.doc_id), r.f) for r in found) == sorted((str(i), plain_fingerprint(t)) for i, t in odd_texts)


def test_repeated_units_take_the_rightmost(spark):
    text = "same " * 60
    kept = spark.createDataFrame([(text,)], "t string").select(winnowing.as_text(winnowing.fingerprint(F.col("t")))).first()[0]
    assert kept == plain_fingerprint(text) and kept.split(" ")[0].endswith(f"@{winnowing.WINDOW - 1}")


def test_shared_passages_are_always_found(spark):
    passage = " ".join(f"p{i}" for i in range(winnowing.WINDOW + winnowing.K - 1))
    rows = [(f"{'a ' * n}{passage} {'b ' * n}", f"{'c ' * (n * 2)}{passage} d") for n in range(12)]
    prints = [winnowing.hashes(winnowing.fingerprint(F.col(c))) for c in ("x", "y")]
    found = spark.createDataFrame(rows, "x string, y string").select(F.size(F.array_intersect(*prints)).alias("n")).collect()
    assert all(r.n >= 1 for r in found)


def test_likeness_of_short_edited_texts(spark):
    rng = random.Random(11)

    def grams(words):
        return {tuple(words[i : i + winnowing.K]) for i in range(len(words) - winnowing.K + 1)}

    rows, share, passage = [], [], []
    for n in [*range(10, 20)] * 14 + [*range(20, 41)] * 5:
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
        at = rng.randrange(n)
        edited = [*words[:at], "other", *words[at + 1 :]]
        rows.append((len(rows), " ".join(words), " ".join(edited)))
        share.append(len(grams(words) & grams(edited)) / len(grams(words) | grams(edited)))
        passage.append(max(at, n - 1 - at))
    kept = [winnowing.hashes(winnowing.fingerprint(F.col(c))) for c in ("x", "y")]
    found = spark.createDataFrame(rows, "i int, x string, y string").select("i", winnowing.likeness(*kept).alias("near")).collect()
    near = [r.near for r in sorted(found)]
    assert all(a > 0 for a, p in zip(near, passage) if p >= winnowing.K + 3)
    short = [(a, s) for a, s, (_, x, _) in zip(near, share, rows) if len(x.split()) < 20]
    assert sum(a == 0 and s > 0 for a, s in short) < 0.15 * len(short)
    assert all(sum(abs(a - s) for a, s in part) < 0.2 * len(part) for part in (short, [*zip(near, share)]))
    assert abs(sum(near) - sum(share)) < 0.1 * len(near)


def plain_cut(run):
    def signed(a, b):
        h = xxhash.xxh64(b.encode(), seed=xxhash.xxh64(a.encode(), seed=42).intdigest()).intdigest()
        return h - (h >> 63 << 64)

    pairs = [signed(a, b) if a != b else None for a, b in zip(run, run[1:])] + [None]
    n, borders = winnowing.UNIT_CHARS, set()
    for i in range(len(pairs)):
        window = pairs[i : i + n]
        least = min((h for h in window if h is not None), default=None)
        borders |= {i + j for j, h in enumerate(window) if h is not None and h == least}
    marked = "".join(" " * (i in borders and i < len(run) - winnowing.WORD_CHARS) + c for i, c in enumerate(run))
    return re.findall(rf"\S{{1,{n}}}", marked)


LETTERS, SIGNS = "abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x4E00, 0x5400)]


def test_long_runs_are_cut_by_content(spark):
    rng = random.Random(3)
    runs = ["".join(rng.choices(a, k=k)) for a in (LETTERS, SIGNS, "ab", "ab😀") for k in (17, 18, 25, 60, 900)]
    runs += ["ab" * 40, "abcdefghij" * 9, "q" * 17, "x" + "q" * 40, "q" * 40 + "x", "q" * 21 + "rst" + "u" * 30]
    texts = [f"one {run} twelve+letters\n{run}" for run in runs]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", winnowing.units(F.col("t")).alias("u")).collect()
    expected = {t: ["one", *plain_cut(r), "twelve+l", "etters", *plain_cut(r)] for t, r in zip(texts, runs)}
    assert {r.t: r.u for r in found} == expected


def test_passages_in_unspaced_runs_are_found_at_every_offset(spark):
    rng = random.Random(4)
    whole = [("".join(rng.choices(a, k=4000)), 0.9) for a in (LETTERS, SIGNS)]
    # Of periodic texts all inner grams are alike, so they count once against those of the start.
    whole += [(text, 0.1) for text in ("abcdefgh" * 500, "ab" * 2000, "z" * 4000)]
    rows = [(text, text[:k][::-1] + text, least) for text, least in whole for k in range(1, 17)]
    length = winnowing.UNIT_CHARS * (winnowing.WINDOW + winnowing.K + 3)
    for alphabet in (LETTERS, SIGNS, "ab"):
        for k in range(40):
            a, b, c, passage = ("".join(rng.choices(alphabet, k=n)) for n in (k, 40 - k, 3 * k, length))
            rows.append((a + passage + b, f"{c}{passage} {c}", 0.0))
    prints = [winnowing.hashes(winnowing.fingerprint(F.col(c))) for c in ("x", "y")]
    common = F.size(F.array_intersect(*prints))
    found = spark.createDataFrame(rows, "x string, y string, least double").select(
        common.alias("n"), winnowing.likeness(*prints).alias("near"), "least"
    )
    assert all(r.n >= 1 and r.near > r.least for r in found.collect())


def test_edited_texts_take_the_next_start(spark, odd_docs, no_docs, odd_texts):
    found = winnowing.compare_with_next(odd_docs).collect()
    assert len(found) == len(odd_texts)
    ids = sorted({i for i, _ in odd_texts if i is not None})
    text_of = dict(odd_texts)
    for r in found:
        text = text_of[r.doc_id] or ""
        following = text_of[ids[(ids.index(r.doc_id) + 1) % len(ids)]] or "" if r.doc_id is not None else ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == plain_fingerprint(text) and r.edited_fingerprint == plain_fingerprint(edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    near = {r.doc_id: r for r in found}
    assert near[6].near_next == 1.0 and near[10].near_next > 0.99 and near[4].near_next < 1
    assert winnowing.compare_with_next(no_docs).count() == 0
    alone = winnowing.compare_with_next(spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


@pytest.mark.parametrize("n", [1, 7, 500])
def test_successors_cross_ranges(spark, n):
    ids = [i * 3 for i in range(n)]
    found = {r.doc_id: r.next_id for r in winnowing.successors(spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(5)).collect()}
    assert found == {a: b for a, b in zip(ids, ids[1:] + ids[:1])}

"""Language-model scores, source audit and spelling groups against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import lm_score, ppm, queries, source_audit, spelling
from marginalia.llm.samples import crc_remainder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- language model ---------------------------------------------------------------------


class PlainTrie:
    """The model with dictionaries, symbol by symbol."""

    def __init__(self, streams):
        self.counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for s in streams:
            padded = ppm.END * ppm.ORDER + s
            for j in range(ppm.ORDER, len(padded)):
                for k in range(ppm.ORDER + 1):
                    self.counts[k][padded[j - k : j]][padded[j]] += 1

    def probability(self, context, symbol):
        p, seen = 1.0, {}
        for k in range(ppm.ORDER, -1, -1):
            here = self.counts[k].get(context[ppm.ORDER - k :], {})
            rest = {s: n for s, n in here.items() if s not in seen}
            if symbol in here:
                return p * here[symbol] / (sum(rest.values()) + len(rest))
            if rest:
                p *= len(rest) / (sum(rest.values()) + len(rest))
            seen = here or seen
        return p / (256 - len(seen))

    def log10(self, s):
        padded = ppm.END * ppm.ORDER + s
        return sum(
            math.log10(self.probability(padded[j - ppm.ORDER : j], padded[j])) for j in range(ppm.ORDER, len(padded))
        )


def plain_scores(rows, held):
    words = [(i, ppm.words_of((t or "").encode()), held(i)) for i, t in rows]
    counts = Counter(w for _, ws, out in words if not out for w in ws + [b""])
    n, v = sum(counts.values()), len(counts)
    trie = PlainTrie([ppm.stream_of(ws) for _, ws, out in words if not out])
    found = []
    for i, ws, out in words:
        ws_end = ws + [b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws_end)
        found.append((i, out, len(ws_end), sum(counts[w] > 0 for w in ws_end), n, base, trie.log10(ppm.stream_of(ws))))
    return found


def is_held(i, divisor=7, remainder=2):
    return i is not None and zlib.crc32(str(i).encode()) % divisor == remainder


def assert_scores(got, expected):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5], r[6])
    got, expected = sorted(map(tuple, got), key=order), sorted(expected, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-6, atol=1e-6)


def test_scores_of_odd_texts(odd_docs, odd_texts, monkeypatch):
    """Small blocks, chunks and merges, so that every seam is crossed."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm_score, "MERGED", 2)
    monkeypatch.setattr(ppm, "CHUNK", 10_000)
    short = odd_docs.withColumn("text", F.substring("text", 1, 60_000))
    got = lm_score.score_texts(short, crc_remainder(F.col("doc_id"), 7) == 2).collect()
    assert_scores(got, plain_scores([(i, t and t[:60_000]) for i, t in odd_texts], is_held))


def test_scores_of_very_long_and_of_no_texts(spark, odd_docs, no_docs):
    held = crc_remainder(F.col("doc_id"), 7) == 2
    assert lm_score.score_texts(odd_docs, held).count() == odd_docs.count()
    assert lm_score.score_texts(no_docs, held).count() == 0
    # Nothing to learn from: all bytes alike.
    rows = lm_score.score_texts(odd_docs.filter("doc_id = 5"), F.lit(True)).collect()
    assert_scores(rows, [(5, True, 5, 0, 0, 0.0, 20 * math.log10(1 / 256))])


def test_probabilities_add_up():
    rng = random.Random(3)
    streams = [bytes(rng.choice(b"abc d") for _ in range(200)) + ppm.END for _ in range(9)]
    trie = PlainTrie(streams)
    for context in (b"\n" * 6, b"abcabc", b"zzzzab", b"a b a "):
        assert math.isclose(sum(trie.probability(context, s) for s in range(256)), 1, rel_tol=1e-9)


def test_registered_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = queries.registered()["op11_lm_score"](spark, sf_dir).collect()
    assert_scores(got, plain_scores([tuple(r) for r in docs.collect()], is_held))


# --- source audit -----------------------------------------------------------------------


def plain_audit(rows, least, top):
    grouped, docs_of = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        grouped[lang, source].update(terms)
        docs_of[lang].update(set(terms))
    kept = {lang: [t for t, n in docs_of[lang].items() if n >= least] for lang in {k[0] for k in grouped}}

    def shares(counts, terms):
        total = sum(counts[t] for t in terms) + 2 * len(terms)
        return {t: 1 + math.floor(Fraction(10**9 * (counts[t] + 2), total)) for t in terms}

    p = {(la, s): shares(c, kept[la]) for (la, s), c in grouped.items()}
    q = {la: shares(sum((c for (x, _), c in grouped.items() if x == la), Counter()), kept[la]) for la in kept}

    def apart(a, b):
        return (a - b) * (a - b) // (a + b)

    out = []
    for (la, s), mine in p.items():
        pairs = [(x, sum(apart(mine[t], p[la, x][t]) for t in kept[la])) for y, x in p if y == la and x != s]
        terms = [(t, apart(mine[t], q[la][t])) for t in kept[la] if grouped[la, s][t] and mine[t] > q[la][t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(la, s, part, item, value, i) for i, (item, value) in enumerate(found, 1)]
    return sorted(out)


def test_audit_against_fractions(spark):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("red", "Blue", "grün", "漢字", "x") for b in ("", "ish", "É", "😀")]
    rows = [
        (rng.choice(["en", "de", None]), f"s{rng.randrange(6) ** 2 % 7}", " ".join(rng.choices(words, k=rng.randrange(9))))
        for _ in range(300)
    ]
    rows += [("en", "s1", "copied red-blue text 1x")] * 40 + [("en", "s4", "copied red-blue text 1x")] * 3
    rows += [("fr", "only", "seul"), ("it", "a", None), ("it", "b", ""), (None, None, None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit(1)).repartition(5)
    for least, top in ((10, 10), (1, 3)):
        got = source_audit.audit(docs, least, top).collect()
        assert sorted(map(tuple, got)) == plain_audit(rows, least, top)


def test_audit_of_odd_and_of_no_texts(odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    got = source_audit.audit(odd_docs.withColumn("terms", F.lit(1)).withColumn("z", F.lit(2)), 2, 10).collect()
    assert sorted(map(tuple, got)) == plain_audit(rows, 2, 10)
    assert source_audit.audit(no_docs).count() == 0


def test_registered_audit(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    expected = con.execute(queries.sql()["op12_source_audit"]).fetchall()
    got = queries.registered()["op12_source_audit"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


# --- spellings --------------------------------------------------------------------------


def plain_near(words):
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_groups(words):
    near, form = plain_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def plain_words(rows, one_in):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def word_table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)


def test_groups_of_dense_and_long_words(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("abç", k=rng.randrange(5, 9))): rng.randrange(3, 500) for _ in range(1500)}
    # Around the bound of the trie, runs of one letter, and chains of forms.
    for size in (47, 48, 49, 50, 300):
        word = "".join(rng.choices("abcd", k=size))
        for k in range(12):
            at = rng.randrange(size)
            words[word[:at] + rng.choice(["", "x", word[at] * 2]) + word[at + 1 :]] = 3 * 2**k
    words |= {"z" * k: 2**30 // k for k in (5, 6, 7, 9, 47, 48, 49, 200)}
    got = spelling.group_spellings(word_table(spark, words)).collect()
    assert sorted(map(tuple, got)) == plain_groups(words)


@pytest.mark.parametrize("one_in", [None, 2])
def test_words_of_odd_texts(spark, odd_docs, odd_texts, one_in):
    thrice = odd_docs.unionByName(odd_docs).unionByName(odd_docs).withColumn("n", F.lit("clash"))
    expected = plain_words([(i, t) for i, t in odd_texts for _ in range(3)], one_in)
    counted = spelling.count_words(thrice, one_in)
    assert {r.word: r.n for r in counted.collect()} == expected
    assert sorted(map(tuple, spelling.group_spellings(counted).collect())) == plain_groups(expected)


def test_no_words(spark, no_docs):
    got = spelling.group_spellings(spelling.count_words(no_docs, 97))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0


def test_registered_spellings(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.registered()["op13_spelling"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == plain_groups(plain_words([tuple(r) for r in docs], 97))

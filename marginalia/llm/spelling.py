"""Words grouped with the more frequent spelling they are one edit away from.

Words are met again as paths through a trie that lies in a table of edges, one row for each
node and next character. A search state is (word, position, node), after its one edit; all states step
forward together, a level per round, by a join with the edges. A word that still has none
of its edit behind it sits on its own path, so these states need no search: each node of the path is
left at once, by a sibling edge (a replaced character) or by the edge of the character after next
(a deleted one); inserted characters are deletions seen from the other word.

Near its root a trie of many words holds every short beginning, and every word would try all of
it. So edits in the second half of a word are looked for in this trie, edits in the first half in a
second one, of the words spelled backwards: either starts in the middle, from a half that must fit
exactly. Where only one word lies below an edge, that word is a candidate and the search ends.
Candidates are confirmed by their true edit distance, so node keys may be hashes.

Words beyond ``LONG`` characters would make long tables of paths; they meet by the hashes of what
is left when any one character is deleted, which finds the same pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

# Letters that words are made of.
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 5
MIN_COUNT = 3
DOMINANCE = 2
LONG = 48

_HELD = 500_000
_RUN = re.compile(f"[{LETTERS}]+")
_PRIME = (1 << 61) - 1
_BASE = 911_382_323_912_853_133
_PATHS = "way int, word string, depth int, node long, sym string, child long"


def words_of(doc_id: object, text: bytes, one_in: int | None) -> Iterator[tuple[str, int]]:
    """Lower-cased runs of a text with their number; of one in so many, a character is dropped."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.lower().decode("utf-8"))).items():
        if one_in:
            crc = zlib.crc32(run.encode(), start)
            if crc % one_in == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
        yield run, n


def count_words(
    docs: DataFrame, one_in: int | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """word, n over all texts, of words long and frequent enough.

    Only A-Z are lower-cased. With ``one_in``, every run whose crc32, after its document's id and a
    colon, is divisible by it loses one character, as a typing error would do. NULL texts have no
    words; a NULL id is written as nothing. Repeated rows count each time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                for word, n in words_of(doc_id, text.as_py() or b"", one_in):
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) > _HELD:
                    yield pa.record_batch({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pa.record_batch({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second half of every word's path, forwards (0) and backwards (1), with an end mark ''."""
    schema = pa.schema(
        [("way", pa.int32()), ("word", pa.string()), ("depth", pa.int32()), ("node", pa.int64()),
         ("sym", pa.string()), ("child", pa.int64())]
    )
    for batch in batches:
        rows: list[tuple] = []
        for word in batch.column("word").to_pylist():
            for way, spelled in ((0, word), (1, word[::-1])):
                node, half = way + 1, len(word) // 2
                for depth, sym in enumerate([*spelled, ""]):
                    child = (node * _BASE + (ord(sym) if sym else 0) + 1) % _PRIME
                    if depth >= half:
                        rows.append((way, spelled, depth, node, sym, child))
                    node = child
        if rows:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# What a branch must hold for a state to go on in it: a word of the right length and last letters.
def _mark(length: str, spelled: str) -> str:
    return f"shiftleft(1L, cast(pmod(xxhash64({length}, right({spelled}, 2)), 64) as int))"


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one exact character on; the mark of the end takes part as a character."""
    here = F.substring("word", F.col("pos") + 1, F.lit(1))
    return (
        states.withColumn("sym", here)
        .join(edges, ["way", "node", "sym"])
        .filter("(marks & mark) <> 0")
        .select("way", "word", (F.col("pos") + 1).alias("pos"), F.col("child").alias("node"), "mark", "words", "only")
    )


def _trie_pairs(words: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) among words of bounded length."""
    paths = stored(words.select("word").mapInArrow(_paths, _PATHS), "spelling-paths")
    edges = paths.groupBy("way", "node", "sym").agg(
        F.first("child").alias("child"),
        F.count(F.lit(1)).alias("words"),
        F.min("word").alias("only"),
        F.expr(f"bit_or({_mark('length(word)', 'word')})").alias("marks"),
    )
    edges = stored(edges, "spelling-edges")
    # Only nodes with several edges offer another way.
    fork = edges.groupBy("way", "node").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("way", "node")
    seeds = stored(
        paths.filter("sym <> ''").select("way", "word", "depth", "node", F.col("sym").alias("own")).join(fork, ["way", "node"]),
        "spelling-seeds",
    )
    # The mark compares last letters, which an edit among them changes: there it lets all pass.
    unsure = "CASE WHEN depth + 3 > length(word) THEN -1L ELSE {} END"
    other = edges.filter("sym <> ''")
    replaced = (
        seeds.withColumn("mark", F.expr(unsure.format(_mark("length(word)", "word"))))
        .join(other, ["way", "node"])
        .filter("sym <> own AND (marks & mark) <> 0")
        .select("way", "word", (F.col("depth") + 1).alias("pos"), F.col("child").alias("node"), "mark", "words", "only")
    )
    deleted = seeds.select(
        "way",
        "word",
        (F.col("depth") + 1).alias("pos"),
        "node",
        F.expr(unsure.format(_mark("length(word) - 1", "word"))).alias("mark"),
    )
    states = stored(replaced.unionByName(_step(deleted, edges)), "spelling-states")
    found = []
    while True:
        found.append(states.filter("words = 1").select("way", "word", F.col("only").alias("other")))
        if states.filter("words > 1").isEmpty():
            break
        states = stored(_step(states.filter("words > 1").drop("words", "only"), edges), "spelling-states")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    spelled = [F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c)).alias(n) for c, n in (("word", "a"), ("other", "b"))]
    return pairs.select(*spelled)


def _without_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, length, spot, id: a hash of the word and of the word without each of its characters."""
    schema = pa.schema([("key", pa.int64()), ("length", pa.int32()), ("spot", pa.int32()), ("id", pa.int64())])
    for batch in batches:
        for word, number in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist()):
            codes = [ord(c) + 1 for c in word]
            tail, tails = 0, [0]
            power = 1
            for code in reversed(codes):
                tail = (code * power + tail) % _PRIME
                power = power * _BASE % _PRIME
                tails.append(tail)
            tails.reverse()
            # Without character i: the head, moved up to stand before the tail after i.
            head, keys = 0, [tails[0]]
            powers = [1]
            for _ in codes:
                powers.append(powers[-1] * _BASE % _PRIME)
            size = len(codes)
            for i, code in enumerate(codes):
                keys.append((head * powers[size - i - 1] + tails[i + 1]) % _PRIME)
                head = (head * _BASE + code) % _PRIME
            lengths, spots = [size] + [size - 1] * size, [-1, *range(size)]
            columns = [keys, lengths, spots, [number] * (size + 1)]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _long_pairs(words: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) among long words."""
    named = words.select("word", F.xxhash64("word").alias("id"))
    keys = stored(named.mapInArrow(_without_one, "key long, length int, spot int, id long"), "spelling-long")
    left, right = keys.filter("spot >= 0"), keys.select("key", "length", F.col("spot").alias("at"), F.col("id").alias("other"))
    # Replaced: both without the same spot are equal. Deleted: one without a spot is the other, whole.
    met = left.join(right, ["key", "length"]).filter("at = spot OR at = -1").select("id", "other").distinct()
    first, second = named.withColumnsRenamed({"word": "a"}), named.withColumnsRenamed({"word": "b", "id": "other"})
    return met.join(first, "id").join(second, "other").select("a", "b")


def near_words(words: DataFrame) -> DataFrame:
    """a, b: all ordered pairs of words with one inserted, deleted or replaced character between them."""
    pairs = _trie_pairs(words.filter(F.char_length("word") <= LONG)).unionByName(
        _long_pairs(words.filter(F.char_length("word") >= LONG))
    )
    real = pairs.filter("a <> b").filter(F.levenshtein("a", "b", 1) == 1)
    both = real.unionByName(real.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of every chain of forms. The way left to go halves each round; it is
    short anyway, since the number of occurrences doubles at each step."""
    current = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = current.join(onward, "root", "left")
        current = stored(joined.select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        if current.filter("next IS NOT NULL").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def group_spellings(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n from distinct words and their numbers.

    A word's form is its near word of largest n, of several the first in code-point order, where
    that n is ``DOMINANCE`` times its own at least, else NULL; root is the end of the chain of
    forms, the word itself if it has none. An empty table gives an empty table.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    pairs = stored(near_words(words), "spelling-near")
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = pairs.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best")
    )
    has_form = -F.col("best.m") >= DOMINANCE * F.col("n")
    found = stored(
        words.join(best, "word", "left").select(
            "word",
            F.when(has_form, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, -F.col("best.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

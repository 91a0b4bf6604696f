"""Document fingerprints by winnowing, in built-in column functions only.

A text is cut into units of at most UNIT_CHARS characters without white space. Runs without
white space are cut where their content says so: before every pair of unequal neighbouring
characters whose hash is the least of some UNIT_CHARS neighbouring pairs (all of equal ones), so
that borders in a passage are the same wherever it stands. The last WORD_CHARS characters of a run,
hence words of up to that length, and repetitions of one character have no such borders; there,
every UNIT_CHARS characters are a unit. Each K
neighbouring units are one gram, whose hash is rolled together from the units' (a cyclic
polynomial: shifted and added without carry). Of every WINDOW neighbouring grams the one with
the least hash is kept, of equal ones the rightmost, together with its place. Any
passage of at least ``WINDOW + K - 1`` units that two texts share gives them a common gram; its
places say where. Within long runs, apart from repetitions of one character at its ends, a shared
passage of ``UNIT_CHARS * (WINDOW + K + 3)`` characters holds that many units.

A kept gram is one long: the hash above, the place (counted in units, modulo 2**23) below.
Likeness is the share of common hashes among all hashes of two fingerprints; two empty ones are
alike.

Defined cases: NULL and empty texts, and texts of white space, have an empty fingerprint; a text
with fewer than K units has one gram of all its units; one with fewer grams than a window
has one window. Rows that repeat get the same fingerprint; other columns do not matter; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

UNIT_CHARS = 8
WORD_CHARS = 2 * UNIT_CHARS
K = 4
WINDOW = 4
PLACE_BITS = 23
HASH_BITS = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _rotate(h: Column, by: int) -> Column:
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def _rolled(cut: Column) -> Column:
    """Hash of each run of K units; of all of them where there are fewer."""

    def grams(h: Column) -> Column:
        rolled = h
        for _ in range(1, K):
            # One more unit at the right; where a run sticks out, NULL is left behind.
            h = F.slice(h, 2, F.greatest(F.size(h), F.lit(1)))
            rolled = F.zip_with(rolled, h, lambda a, b: _rotate(a, 1).bitwiseXOR(b))
        return rolled

    def short(h: Column) -> Column:
        return F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, b: _rotate(a, 1).bitwiseXOR(b)))

    hashes = F.transform(cut, lambda u: F.xxhash64(u))
    return _let(
        hashes,
        lambda h: F.when(F.size(h) == 0, F.slice(h, 1, 0))
        .when(F.size(h) < K, short(h))
        .otherwise(F.slice(grams(h), 1, F.size(h) - K + 1)),
    )


def _sliding(values: Column, width: int, of: Callable[..., Column]) -> Column:
    """``of`` (least or greatest) each value and the ``width - 1`` after it, as far as there are any."""

    def with_later(step: int) -> Callable[[Column], Column]:
        return lambda m: F.zip_with(m, F.slice(m, step + 1, F.greatest(F.size(m), F.lit(1))), lambda a, b: of(a, b))

    found, done = values, 1
    while done < width:
        step = min(done, width - done)
        found = _let(found, with_later(step))
        done += step
    return found


def _cut(run: Column) -> Column:
    """Units of a long run, between borders that depend on the characters around them."""

    def marked(c: Column) -> Column:
        # NULL, never a border, for equal neighbours and the last character.
        pairs = F.zip_with(c, F.slice(c, 2, F.size(c)), lambda a, b: F.when(a != b, F.xxhash64(a, b)))
        inner = F.greatest(F.size(c) - WORD_CHARS, F.lit(0))
        return _let(pairs, lambda h: F.array_join(F.zip_with(c, F.slice(borders(h), 1, inner), spaced), ""))

    def borders(h: Column) -> Column:
        # A pair is the least of some window if it equals the greatest least of those it lies in.
        before = F.array_repeat(F.lit(None).cast("long"), UNIT_CHARS - 1)
        least = F.concat(before, _sliding(h, UNIT_CHARS, F.least))
        return F.zip_with(h, _sliding(least, UNIT_CHARS, F.greatest), lambda a, b: a == b)

    def spaced(char: Column, border: Column) -> Column:
        return F.when(border, F.concat(F.lit(" "), char)).otherwise(char)

    chars = F.regexp_extract_all(run, F.lit(r"\S"), F.lit(0))
    return F.regexp_extract_all(_let(chars, marked), F.lit(rf"\S{{1,{UNIT_CHARS}}}"), F.lit(0))


def units(text: Column) -> Column:
    """What a text is cut into, in its order."""
    pattern = rf"\S{{{WORD_CHARS + 1},}}|\S{{1,{UNIT_CHARS}}}"
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))

    def long(run: Column) -> Column:
        return F.length(run) > WORD_CHARS

    def cut(r: Column) -> Column:
        return F.flatten(F.transform(r, lambda run: F.when(long(run), _cut(run)).otherwise(F.array(run))))

    return _let(runs, lambda r: F.when(F.exists(r, long), cut(r)).otherwise(r))


def fingerprint(text: Column) -> Column:
    """Kept grams in the order of the text, each once."""
    mask = F.lit((1 << HASH_BITS) - 1)
    last = F.lit((1 << PLACE_BITS) - 1)

    def placed(h: Column, i: Column) -> Column:
        # Of equal hashes the one further right has the smaller number.
        return F.shiftleft(F.xxhash64(h).bitwiseAND(mask), PLACE_BITS).bitwiseOR(last - i.cast("long").bitwiseAND(last))

    def minima(g: Column) -> Column:
        return F.slice(_sliding(g, WINDOW, F.least), 1, F.greatest(F.size(g) - WINDOW + 1, F.least(F.size(g), F.lit(1))))

    return F.array_distinct(_let(F.transform(_rolled(units(text)), placed), minima))


def hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda g: F.shiftright(g, PLACE_BITS)))


def place(kept: Column) -> Column:
    """Units before a kept gram."""
    last = F.lit((1 << PLACE_BITS) - 1)
    return last - kept.bitwiseAND(last)


def as_text(kept: Column) -> Column:
    """``hash@place`` of every kept gram, hashes in hexadecimal digits."""
    return F.concat_ws(
        " ", F.transform(kept, lambda g: F.concat(F.lower(F.hex(F.shiftright(g, PLACE_BITS))), F.lit("@"), place(g).cast("string")))
    )


def likeness(a: Column, b: Column) -> Column:
    """Common hashes over all hashes of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / F.greatest(union, F.lit(1)))


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, next_id in ascending order of the distinct ids; the first follows the last.

    Ids are sorted by ranges; the last of a range takes the first id of the next one from a table
    with one row for each range.
    """
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().repartitionByRange("doc_id")
    ranged = stored(ids.select("doc_id", F.spark_partition_id().alias("range")), "ranges")
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first"))
    ends = firsts.select(
        "range",
        F.coalesce(
            F.lead("first").over(Window.orderBy("range")),
            F.first("first").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        ).alias("after"),
    )
    inside = ranged.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("range").orderBy("doc_id")))
    return inside.join(ends, "range").select("doc_id", F.coalesce("next_id", "after").alias("next_id"))


def with_next_half(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, next_id, next_text, edited: the last half of each text (rounded down)
    replaced by as much of the start of the next document.

    A row without ``doc_id`` has no next document, and its last half is only cut off; of rows that
    share the next id, the least text counts.
    """
    all_texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Sort-merge joins at every size: the first two deal out the same rows in the same way, so Spark
    # shuffles the texts once for both, and once more as next texts.
    texts = all_texts.filter("doc_id is not null")
    order = stored(successors(docs), "order")
    wanted = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("of"))
    following = (
        texts.join(wanted.hint("merge"), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("of").alias("of"), F.min("text").alias("next_text"))
        .select("of", F.col("doc_id").alias("next_id"), "next_text")
    )
    followed = (
        texts.join(following.hint("merge"), F.col("doc_id") == F.col("of"), "left")
        .select("doc_id", "text", "next_id", "next_text")
    )
    nameless = all_texts.filter("doc_id is null").select(
        "doc_id", "text", F.col("doc_id").alias("next_id"), F.lit(None).cast("string").alias("next_text")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    return followed.unionByName(nameless).select(
        "doc_id", "text", n.cast("long").alias("n_chars"), "next_id", "next_text", edited.alias("edited")
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited form, and how alike they are.

    The next text comes along whole and is fingerprinted where it arrives, which is less to move
    and keep than fingerprints are.
    """
    both = with_next_half(docs).select(
        "doc_id", "n_chars", "next_id",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("kept"),
        fingerprint(F.col("edited")).alias("edited_kept"),
        hashes(fingerprint(F.col("next_text"))).alias("next_hashes"),
    )
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("kept")).alias("fingerprint"),
        as_text(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(hashes(F.col("kept")), hashes(F.col("edited_kept"))).alias("near_edited"),
        F.when(F.col("next_id").isNull(), 0.0).otherwise(likeness(hashes(F.col("kept")), F.col("next_hashes"))).alias("near_next"),
    )

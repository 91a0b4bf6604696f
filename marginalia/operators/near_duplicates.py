"""Near-duplicate texts: an exact join of sets of word shingles by Jaccard similarity.

Equal texts are collapsed. A first look sends about 30 % of each text's shingles, in the order of their hashes,
and leaves out the texts that have too few of these in common with all others together; only the sets
of the rest move. Their shingles are put in one global order, rarest first. Two sets as similar as asked for
share a shingle among the first few of either (the *prefix*), so only those are joined, and only between sets
of fitting size whose places in the order still allow enough common shingles. Shingles that a single text
holds lead its prefix and meet nothing, so they are never joined at all. What meets is confirmed on whole sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.bloom import bloom_filter, may_contain
from marginalia.functions.numbers import percent, thousands
from marginalia.functions.text import normalise
from marginalia.operators.checks import Check, when_any
from marginalia.operators.once import compute_once
from marginalia.sources.paths import stored

WORDS = 5
PERCENT = 80
# The first look asks for a tenth of a set in common.
LOOK = 10


def shingles(split: Column, words: int = WORDS) -> Column:
    """Distinct 64-bit hashes of all runs of ``words`` of the words in an array; of a shorter
    one all of it as one run, of an empty one none. Give it a column: what it is computed
    by would be computed again for every run."""
    last = F.greatest(F.size(split) - words, F.lit(0))
    # Word by word: a slice would copy the whole array for each run. NULLs beyond the end are not hashed.
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(split, i + k) for k in range(words)]))
    return F.when(F.size(split) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<long>"))


def _classes(df: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key, n, shingles in order) and classes (key, class_id, copies, n) of equal normalised texts.

    ``class_id`` is the least id of a class. NULL counts as the empty text.
    """
    normal = df.select(F.col(id_col).alias("id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    norm = F.col("norm")
    split = compute_once(
        normal, ["id"],
        {"key": F.unhex(F.substring(F.sha2(norm, 256), 1, 32)), "split": F.filter(F.split(norm, " "), lambda w: w != "")},
    )
    keyed = compute_once(split, ["id", "key"], {"shingles": F.sort_array(shingles(F.col("split"), words))})
    keyed = stored(keyed.withColumn("n", F.size("shingles")), "near-keys")
    classes = keyed.groupBy("key").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"))
    return keyed, stored(classes, "near-classes")


def _needed(n: str, percent_alike: int) -> str:
    """Least number of shingles that a set of ``n`` shares with a similar one."""
    return f"(({percent_alike} * {n} + 99) div 100)"


def _told(n: str) -> str:
    """How many common shingles the first look asks for, beyond the one that a prefix is made for."""
    return f"greatest(1, {n} div {LOOK})"


def with_partners(keyed: DataFrame, classes: DataFrame, percent_alike: int = PERCENT) -> DataFrame:
    """key, n, shingles: the classes that may have a similar text.

    Sets of ``n`` share at least ``needed(n)`` shingles with any partner. Of those, as many as ``told`` are among
    the first ``n - needed + told`` of either set, in the order of the hashes. So only these are
    sent to where they meet, and a text stays in when enough of them are also found in other texts. A partner is
    no smaller than ``needed(n)``, which bounds what it asks for.
    """
    needed = _needed("n", percent_alike)
    first = F.slice("shingles", F.lit(1), F.expr(f"least(n, n - {needed} + {_told('n')})").cast("int"))
    token = F.xxhash64("key").alias("token")
    posted = keyed.filter("n > 0").select(token, F.explode(first).alias("shingle"))
    # Copies have one token, so they are no company for one another.
    list_ = Window.partitionBy("shingle")
    met = posted.select("token", (F.min("token").over(list_) < F.max("token").over(list_)).alias("met")).filter("met")
    # Rows of copies are counted each: a class of c copies needs c times as many.
    counts = met.groupBy("token").agg(F.count(F.lit(1)).alias("met"))
    asked = classes.withColumn("token", F.xxhash64("key")).join(counts, "token")
    wanted = stored(asked.filter(f"met >= copies * {_told(needed)}").select("key", "class_id"), "near-wanted")
    n = wanted.count()
    row = F.xxhash64("key", "id")
    rows = keyed
    words = bloom_filter(wanted.select(F.xxhash64("key", "class_id").alias("row")), "row", n)
    if words is not None:  # only the first row of a wanted class moves; beyond the bound, copies do, too
        rows = rows.filter(may_contain(words, row, n))
    found = rows.join(wanted.select("key"), "key").groupBy("key")
    return stored(found.agg(F.any_value("n").alias("n"), F.any_value("shingles").alias("shingles")), "near-wanted-sets")


def _ordered(classes: DataFrame) -> DataFrame:
    """key, n, alone, common: how many shingles no other text has, and the rest, rarest first."""
    held = classes.select("key", "n", F.explode("shingles").alias("shingle"))
    shared = held.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).filter("texts > 1")
    common = F.sort_array(F.collect_list(F.struct("texts", "shingle")))
    return (
        shared.groupBy("key", "n")
        .agg(F.transform(common, lambda x: x["shingle"]).alias("common"))
        .withColumn("alone", F.col("n") - F.size("common"))
    )


def similar_pairs(classes: DataFrame, percent_alike: int = PERCENT) -> DataFrame:
    """a, b, overlap, union_size: all pairs of different texts at least so similar, by their keys. ``classes``
    are keys with ``n`` and ``shingles``.

    The shorter set is ``a``; of equal ones, that of the lesser key.
    """
    sets = stored(_ordered(classes), "near-sets")
    p = percent_alike
    # A set of n must share ceil(p n / 100) with any partner: one of them is in its first n - that + 1.
    reach = F.expr(f"n - ({p} * n + 99) div 100 + 1 - alone")
    # Sizes in bands whose ratio is the least one allowed: partners are in the same band or the next.
    band = F.floor(F.log(F.col("n")) / -math.log(p / 100)).cast("int")
    first = sets.withColumn("reach", reach.cast("int")).filter("reach > 0")
    posted = first.select(
        "key", "n", "alone", band.alias("band"), F.posexplode(F.slice("common", F.lit(1), F.col("reach"))).alias("at", "shingle")
    ).withColumn("at", F.col("at") + F.col("alone"))
    shorter = posted.select("shingle", "band", F.col("key").alias("a"), F.col("n").alias("m"), F.col("at").alias("i"))
    # One band back for rounding at a border, too.
    near_bands = F.explode(F.array(F.col("band"), F.col("band") - 1, F.col("band") - 2))
    longer = posted.select("shingle", near_bands.alias("band"), F.col("key").alias("b"), "n", F.col("at").alias("j"))
    fits = (
        f"(m < n OR (m = n AND a < b)) AND 100 * m >= {p} * n AND "
        f"(100 + {p}) * (least(i, j) + 1 + least(m - i, n - j) - 1) >= {p} * (m + n)"
    )
    met = shorter.join(longer, ["shingle", "band"]).filter(fits).select("a", "b").distinct()
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("m"), F.col("common").alias("of_a"))
    right = sets.select(F.col("key").alias("b"), "n", F.col("common").alias("of_b"))
    overlap = F.size(F.array_intersect("of_a", "of_b"))
    pairs = met.join(left, "a").join(right, "b").select("a", "b", overlap.alias("overlap"), F.expr("m + n").alias("both"))
    return pairs.filter(f"(100 + {p}) * overlap >= {p} * both").select(
        "a", "b", "overlap", (F.col("both") - F.col("overlap")).alias("union_size")
    )


def near_duplicate_pairs(
    df: DataFrame, id_col: str = "source_id", text_col: str = "text", words: int = WORDS, percent_alike: int = PERCENT
) -> DataFrame:
    """id_a < id_b, overlap, union_size: similar pairs of different texts, by their classes' least ids."""
    keyed, classes = _classes(df, id_col, text_col, words)
    pairs = similar_pairs(with_partners(keyed, classes, percent_alike), percent_alike)
    names = classes.select("key", "class_id")
    named = pairs.join(names.withColumnsRenamed({"key": "a", "class_id": "x"}), "a").join(
        names.withColumnsRenamed({"key": "b", "class_id": "y"}), "b"
    )
    return named.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "overlap", "union_size")


def near_duplicates(
    df: DataFrame, id_col: str = "source_id", text_col: str = "text", words: int = WORDS, percent_alike: int = PERCENT
) -> DataFrame:
    """id, class_id, copies, n_shingles, n_near: every row with its class of equal texts and the
    number of different texts that are similar to it."""
    keyed, classes = _classes(df, id_col, text_col, words)
    pairs = similar_pairs(with_partners(keyed, classes, percent_alike), percent_alike)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    near = ends.groupBy("key").agg(F.count(F.lit(1)).alias("n_near"))
    found = classes.join(near, "key", "left").select(
        "key", "class_id", "copies", F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")
    )
    return keyed.select("id", "key").join(found, "key").drop("key")


def near_duplicate_check() -> Check:
    """Over ``near_duplicates``: a row counts when it has a copy or a similar text."""
    rows, near = F.col("n_rows"), F.col("near_duplicates")
    return Check(
        name="Near Duplicates",
        totals={
            "n_rows": F.count(F.lit(1)),
            "near_duplicates": F.count_if((F.col("n_near") > 0) | (F.col("copies") > 1)),
            "different_but_similar": F.count_if(F.col("n_near") > 0),
        },
        figures={
            "near_duplicates": near,
            "near_duplicate_pct": percent(near, rows),
            "different_but_similar": F.col("different_but_similar"),
        },
        passed=near == 0,
        issues=[when_any(near, thousands(near), " texts with copies or near copies")],
        reason=F.when(rows == 0, "No records to check."),
    )


def check_near_duplicates(df: DataFrame, id_col: str = "source_id", text_col: str = "text") -> DataFrame:
    return near_duplicate_check().run(near_duplicates(df, id_col, text_col))

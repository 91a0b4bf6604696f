"""How far the sources of a language lie apart in the terms they use.

Identical texts of a language are collapsed first: one copy is cut into terms, and its counts
are added for every source as often as that source holds it. Terms are runs of letters A-Z
(lower-cased) and of characters beyond ASCII. A language keeps the terms that enough of its
documents hold; each kept term has a share, in billionths, in every source of the language,
also where it does not occur, and in the language as a whole. Two shares p, q lie
``(p-q)*(p-q)/(p+q)`` apart, rounded down.

NULL text, language and source count as empty. Repeated rows count as often as they are there;
a source without terms still takes part, at the shares of absent terms; an empty table gives no
row. A very long text is held whole, alone, by one Python worker. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.paths import stored

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000

# Counted terms a worker holds before it hands them on.
_HELD = 600_000
# Upper case to lower, everything else in ASCII that is no letter to a space. Bytes of other
# characters stay, so terms may be cut from UTF-8 without decoding.
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


def collapse(docs: DataFrame) -> DataFrame:
    """lang, text, copies: each text of a language once, with its number of copies per source.

    ``copies`` has one entry for each source that holds the text, not for each copy; the text
    is combined before it moves, so one copied into a third of all rows moves once per task.
    """
    rows = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    per_source = rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = per_source.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", F.col("text").cast("binary").alias("text"), "copies")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in held.items():
            total = len(found)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * total, pa.string()),
                    "source": pa.array([source] * total, pa.string()),
                    "term": pa.array(list(found), pa.binary()).cast(pa.string()),
                    "n": pa.array([x[0] for x in found.values()], pa.int64()),
                    "docs": pa.array([x[1] for x in found.values()], pa.int64()),
                }
            )

    for batch in batches:
        for lang, text, copies in zip(*[batch.column(c) for c in ("lang", "text", "copies")]):
            counts = Counter(terms_of(text.as_py()))
            lang = lang.as_py()
            for copy in copies.as_py():
                times = copy["n"]
                found = held[lang, copy["source"]]
                before = len(found)
                for term, n in counts.items():
                    entry = found.get(term)
                    if entry is None:
                        found[term] = [n * times, times]
                    else:
                        entry[0] += n * times
                        entry[1] += times
                size += len(found) - before
                if size > _HELD:
                    yield from out()
                    held.clear()
                    size = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term in every source."""
    partial = collapse(docs).mapInArrow(_count, _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> Column:
    """In billionths, plus one; whole numbers throughout, of any size."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))) "
        f"div cast({total} + 2 * terms as decimal(20,0))"
    )


def apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: all other sources of the language, farthest first. ``term``: the terms that set
    a source apart from its language most, among those it uses more.
    """
    of_term = Window.partitionBy("lang", "term")
    # A window holds one row for each source that uses the term.
    kept = (
        term_counts(docs)
        .withColumns(
            {
                "lang_docs": F.sum("docs").over(of_term),
                "lang_n": F.sum("n").over(of_term),
                "first": F.col("source") == F.min("source").over(of_term),
            }
        )
        .filter(F.col("lang_docs") >= min_documents)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )
    kept = stored(kept, "audit-terms")
    groups = (
        docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
        .groupBy("lang", "source")
        .agg(F.lit(0).cast("long").alias("none"))
        .drop("none")
    )
    in_lang = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    in_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(in_lang, "lang", "left").join(in_source, ["lang", "source"], "left").fillna(0)
    # z is the share of a kept term that the source lacks.
    absent = F.when(F.col("terms") > 0, _share("0L", "total")).otherwise(F.lit(0).cast("long"))
    groups = stored(groups.withColumn("z", absent), "audit-groups")
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"), "z"
    )
    shares = stored(shares, "audit-shares")
    return _pairs(shares, groups).unionByName(_terms(shares, top_terms))


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    found = shares.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value")
    )
    return _ranked(found, "term").filter(F.col("rank") <= top)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Distances of sources, from the terms they hold.

    Were every kept term absent from both, their distance would be that of the absent shares,
    times the number of terms. A term only one side holds changes its part of that sum; such
    terms count by their share, of which a source has few different ones. Only terms that both
    hold are looked at one by one, and put the changes of both sides right.
    """
    side = ["lang", "source", "z"]
    by_share = shares.groupBy(*side, "p").agg(F.count(F.lit(1)).alias("m"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("y"), "terms")
    alone = (
        by_share.join(other, "lang")
        .filter("source <> item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.expr(f"m * ({apart('p', 'y')} - {apart('z', 'y')})")).alias("value"))
    )
    everywhere = groups.join(other.drop("terms"), "lang").filter("source <> item")
    everywhere = everywhere.select(
        "lang", "source", "item", F.expr(f"CASE WHEN terms > 0 THEN terms * ({apart('z', 'y')}) ELSE 0L END").alias("value")
    )
    mine = shares.select("lang", "term", "source", "p", "z")
    theirs = shares.select(
        "lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("z").alias("y")
    )
    both = (
        mine.join(theirs, ["lang", "term"])
        .filter("source < item")
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(
                F.expr(f"({apart('p', 'r')}) - ({apart('p', 'y')}) - ({apart('z', 'r')}) + ({apart('z', 'y')})")
            ).alias("value")
        )
    )

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    summed = (
        everywhere.unionByName(alone)
        .unionByName(turned(alone))
        .unionByName(both)
        .unionByName(turned(both))
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    return _ranked(summed, "pair")

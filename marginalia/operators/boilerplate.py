"""Lines that many texts share, and how much of each text they make up.

A line is known by the digest of its normalised form, so no text or line is ever shuffled. Each
text counts a line once. The digests that are frequent enough go into a Bloom filter, and only
lines it lets through are joined with them: rare lines, nearly all of most corpora, stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.bloom import bloom_filter, may_contain
from marginalia.functions.numbers import percent, thousands
from marginalia.functions.text import normalise
from marginalia.operators.checks import Check, when_any
from marginalia.sources.paths import stored

# A line of so many texts is boilerplate; a text of which it makes up this share of lines is flagged.
MIN_TEXTS = 10
MOSTLY_PCT = 50


def _digest(line: Column) -> Column:
    """128 bits of SHA-256, as text: arrays of texts are made distinct in linear time."""
    return F.substring(F.sha2(line, 256), 1, 32)


def _lines(text: Column) -> Column:
    """line, digest, chars of every line that is not blank, in order."""
    raw = F.split(F.coalesce(text, F.lit("")), "\n")
    numbered = F.transform(raw, lambda x, i: F.struct(i.alias("line"), normalise(x).alias("norm")))
    return F.transform(
        F.filter(numbered, lambda x: x["norm"] != ""),
        lambda x: F.struct(x["line"], _digest(x["norm"]).alias("digest"), F.char_length(x["norm"]).alias("chars")),
    )


def frequent_lines(df: DataFrame, text_col: str = "text", min_texts: int = MIN_TEXTS) -> DataFrame:
    """digest, texts: lines that at least ``min_texts`` rows hold, blank ones left out."""
    digests = F.array_distinct(F.transform(_lines(F.col(text_col)), lambda x: x["digest"]))
    return (
        df.select(F.explode(digests).alias("digest"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("texts"))
        .filter(F.col("texts") >= min_texts)
    )


def flagged_lines(
    df: DataFrame, id_col: str = "source_id", text_col: str = "text", min_texts: int = MIN_TEXTS
) -> DataFrame:
    """id, nth, line, chars, texts: every frequent line of every text.

    ``line`` counts from 0 over all lines of the text, ``nth`` over those that are not blank. Ids
    must tell rows apart.
    """
    frequent = stored(frequent_lines(df, text_col, min_texts), "frequent-lines")
    n = frequent.count()
    lines = df.select(F.col(id_col).alias("id"), F.posexplode(_lines(F.col(text_col))).alias("nth", "found"))
    lines = lines.select("id", "nth", "found.*")
    words = bloom_filter(frequent, "digest", n)
    if words is not None:
        lines = lines.filter(may_contain(words, F.col("digest"), n))
    return lines.join(frequent, "digest").select("id", "nth", "line", "chars", "texts")


def boilerplate_runs(flagged: DataFrame) -> DataFrame:
    """id, start_line, end_line, n_lines: longest stretches of flagged lines; blank ones do not end them."""
    behind = F.col("nth") - F.row_number().over(Window.partitionBy("id").orderBy("nth"))
    return (
        flagged.withColumn("run", behind)
        .groupBy("id", "run")
        .agg(
            F.min("line").alias("start_line"),
            F.max("line").alias("end_line"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        .drop("run")
    )


def boilerplate_shares(
    df: DataFrame, id_col: str = "source_id", text_col: str = "text", min_texts: int = MIN_TEXTS
) -> DataFrame:
    """id, n_lines, n_flagged, flagged_pct, n_runs, longest_run: one row per text, also without any."""
    lines = F.size(_lines(F.col(text_col))).cast("long")
    none = F.lit(0).cast("long")
    whole = df.select(
        F.col(id_col).alias("id"), lines.alias("n_lines"), none.alias("n_flagged"), none.alias("runs"), none.alias("longest")
    )
    runs = boilerplate_runs(flagged_lines(df, id_col, text_col, min_texts)).select(
        "id", none.alias("n_lines"), F.col("n_lines").alias("n_flagged"), F.lit(1).cast("long").alias("runs"), F.col("n_lines").alias("longest")
    )
    summed = whole.unionByName(runs).groupBy("id").agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum("n_flagged").alias("n_flagged"),
        F.sum("runs").alias("n_runs"),
        F.max("longest").alias("longest_run"),
    )
    return summed.withColumn("flagged_pct", percent(F.col("n_flagged"), F.col("n_lines")))


def boilerplate_check() -> Check:
    """Over ``boilerplate_shares``: a text that is mostly boilerplate fails, some of it is only noted."""
    texts, some, mostly = F.col("n_texts"), F.col("with_boilerplate"), F.col("mostly_boilerplate")
    return Check(
        name="Boilerplate",
        totals={
            "n_texts": F.count(F.lit(1)),
            "n_lines": F.coalesce(F.sum("n_lines"), F.lit(0)),
            "flagged_lines": F.coalesce(F.sum("n_flagged"), F.lit(0)),
            "with_boilerplate": F.count_if(F.col("n_flagged") > 0),
            "mostly_boilerplate": F.count_if(F.col("flagged_pct") >= MOSTLY_PCT),
            "longest_run": F.coalesce(F.max("longest_run"), F.lit(0)),
        },
        figures={
            "n_texts": texts,
            "n_lines": F.col("n_lines"),
            "flagged_lines": F.col("flagged_lines"),
            "flagged_lines_pct": percent(F.col("flagged_lines"), F.col("n_lines")),
            "with_boilerplate": some,
            "mostly_boilerplate": mostly,
            "longest_run": F.col("longest_run"),
        },
        passed=mostly == 0,
        issues=[
            when_any(mostly, thousands(mostly), f" texts at least {MOSTLY_PCT}% boilerplate"),
            when_any(some, thousands(some), " texts with lines that many texts share"),
        ],
        reason=F.when(texts == 0, "No texts to check."),
    )


def check_boilerplate(
    df: DataFrame, id_col: str = "source_id", text_col: str = "text", min_texts: int = MIN_TEXTS
) -> DataFrame:
    return boilerplate_check().run(boilerplate_shares(df, id_col, text_col, min_texts))

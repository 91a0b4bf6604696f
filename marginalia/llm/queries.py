"""One registered query per dealt operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import (
    binary_ids,
    bpe_stream,
    exact_dedup,
    language_id,
    lm_score,
    minhash,
    packing,
    source_audit,
    spelling,
    token_rollup,
    toxicity,
    url_filter,
    winnowing,
)
from marginalia.llm.samples import crc_remainder
from marginalia.llm.shipping import shipped
from marginalia.sources.paths import shared_folder, stored

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = shipped(fn)
    return _QUERIES[fn.__name__]


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Host and path rules.
URL_RULES = [
    url_filter.listed("org", "/", allow=True),
    url_filter.listed("example.org", "/es/", allow=False),
    url_filter.listed("example.org", "/en/1", allow=False),
    url_filter.listed("com", "/fr/", allow=True),
    url_filter.listed("com", "/de/", allow=False),
]


@query
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES + url_filter.UNWANTED)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_SQL["op1_url_filter"] = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT page_id, host, path,
    arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rules.verdict, length(rule_host || rule_path)) AS verdict
  FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule,
  CASE WHEN verdict IS NOT NULL THEN verdict
       WHEN regexp_matches(host || path, '(?i)(^|[^A-Za-z0-9])({"|".join(url_filter.UNWANTED_WORDS)})($|[^A-Za-z0-9])')
       THEN 'block' ELSE 'allow' END AS verdict
FROM best
"""


@query
def op2_binary_ids(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "ids")
    binary_ids.write_ids(table(spark, sf, "documents"), folder, end_id=2)
    return binary_ids.read_ids(spark, folder, with_ids=False)


@query
def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


_SQL["op5_exact_dedup"] = r"""
WITH bare AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
    length(coalesce(text, '')) AS n_chars
  FROM documents
)
SELECT doc_id, text_sha256, keep_id, group_size, doc_id = keep_id AS kept FROM (
  SELECT doc_id, text_sha256,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM bare
)
"""


@query
def op3_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf, "documents"), minhash.Rule(words=2, percent=80)).drop("text_hash")


@query
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.encode_pieces(table(spark, sf, "documents"), with_ids=False)
    return packing.pack(pieces).drop("ids")


@query
def op10_bpe_stream(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_stream.round_trip_digests(bpe_stream.encode(table(spark, sf, "documents")))


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, table(spark, sf, "labels").filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    network = language_id.fit(docs.filter(~held_out))
    found = language_id.identify(docs, network)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return winnowing.compare_with_next(table(spark, sf, "documents"))


@query
def op9_token_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents come in, toxic ones are taken down, good ones are counted anew without
    white space around and between words; the first batch is committed twice, as by a retry."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    ledger = shared_folder(spark, "token-ledger")
    counts = stored(token_rollup.count_tokens(docs), "token-counts")

    def of(condition: str) -> DataFrame:
        return labels.filter(condition).select("doc_id").distinct()

    good = of("toxic = 0 and quality = 1")
    # Every text is counted in both ways where it lies; only counts meet the labels.
    tidied = docs.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    tidied = stored(token_rollup.count_tokens(tidied), "tidied-counts")
    revised = tidied.join(good, "doc_id").withColumn("tokenizer", F.concat("tokenizer", F.lit(" tidied")))
    for batch, changes in (
        ("1-load", token_rollup.inserts(counts)),
        ("2-take-down", token_rollup.deletes(counts.join(of("toxic = 1"), "doc_id"))),
        ("3-recount", token_rollup.revisions(counts.join(good, "doc_id"), revised)),
        ("1-load", token_rollup.inserts(counts)),
    ):
        token_rollup.commit(spark, ledger, batch, changes)
    return token_rollup.totals(spark, ledger)

@query
def op12_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    return source_audit.audit(table(spark, sf, "documents"))


_SQL["op12_source_audit"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), tokens AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), sizes AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM d
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.lang_n::HUGEINT AS lang_n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (
  SELECT lang, source, sum(n) AS total FROM grid GROUP BY lang, source
), shares AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM grid JOIN totals USING (lang, source) JOIN sizes USING (lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_spellings(spelling.count_words(table(spark, sf, "documents"), one_in=97))


@query
def op11_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf, "documents"), crc_remainder(F.col("doc_id"), 7) == 2)

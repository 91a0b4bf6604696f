"""Token ledgers, the pipeline, and the queries that SQL can express."""

import os
import re

import oracle
import pytest

import corpus_pipeline
from marginalia.llm import queries, token_rollup
from marginalia.llm.tokens import tokenizer

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def totals(spark, ledger):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in token_rollup.totals(spark, ledger).collect()}


def test_counts_of_whole_texts(odd_docs, no_docs, odd_texts):
    found = sorted((str(r.doc_id), r.tokens) for r in token_rollup.count_tokens(odd_docs).collect())
    assert found == sorted((str(i), len(tokenizer().encode(t or "", add_special_tokens=False).ids)) for i, t in odd_texts)
    assert token_rollup.count_tokens(no_docs).count() == 0


def test_batches_add_up_and_repeat_safely(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    assert totals(spark, ledger) == {}
    schema = "source string, lang string, tokenizer string, tokens long"
    first = spark.createDataFrame([("a", "en", "v1", 10), ("a", "en", "v1", 5), ("b", None, "v1", 7), (None, "fr", "v1", 0)], schema)
    token_rollup.commit(spark, ledger, "1", token_rollup.inserts(first))
    loaded = {("a", "en", "v1"): (2, 15), ("b", None, "v1"): (1, 7), (None, "fr", "v1"): (1, 0)}
    assert totals(spark, ledger) == loaded
    gone = spark.createDataFrame([("b", None, "v1", 7)], schema)
    token_rollup.commit(spark, ledger, "2", token_rollup.deletes(gone))
    token_rollup.commit(spark, ledger, "2", token_rollup.deletes(gone))
    token_rollup.commit(spark, ledger, "1", token_rollup.inserts(first))
    del loaded["b", None, "v1"]
    assert totals(spark, ledger) == loaded
    before = spark.createDataFrame([("a", "en", "v1", 10)], schema)
    after = spark.createDataFrame([("a", "en", "v2", 12)], schema)
    token_rollup.commit(spark, ledger, "3", token_rollup.revisions(before, after))
    token_rollup.commit(spark, ledger, "4", token_rollup.inserts(first.limit(0)))
    assert totals(spark, ledger) == loaded | {("a", "en", "v1"): (1, 5), ("a", "en", "v2"): (1, 12)}
    # An attempt with other, or no, changes takes the place of the earlier one.
    token_rollup.commit(spark, ledger, "3", token_rollup.inserts(first.limit(0)))
    token_rollup.commit(spark, ledger, "4", token_rollup.inserts(after))
    assert totals(spark, ledger) == loaded | {("a", "en", "v2"): (1, 12)}


def test_more_than_there_is_cannot_go(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    schema = "source string, lang string, tokenizer string, tokens long"
    one = spark.createDataFrame([(None, "en", "v1", 10)], schema)
    with pytest.raises(ValueError, match="more than there is"):
        token_rollup.commit(spark, ledger, "0", token_rollup.deletes(one))
    token_rollup.commit(spark, ledger, "1", token_rollup.inserts(one))
    token_rollup.commit(spark, ledger, "2", token_rollup.deletes(one))
    with pytest.raises(ValueError, match="more than there is"):
        token_rollup.commit(spark, ledger, "3", token_rollup.deletes(one))
    # The load cannot be taken back either while its documents are deleted by another batch.
    with pytest.raises(ValueError, match="more than there is"):
        token_rollup.commit(spark, ledger, "1", token_rollup.inserts(one.limit(0)))
    assert totals(spark, ledger) == {}


def test_compaction_keeps_totals_and_closes_batches(spark, tmp_path):
    old, new, newer = (f"{tmp_path}/{n}" for n in ("old", "new", "newer"))
    schema = "source string, lang string, tokenizer string, tokens long"
    rows = spark.createDataFrame([("a", "en", "v1", 10), (None, None, "v1", 3)], schema)
    for batch in ("1", "2", "3"):
        token_rollup.commit(spark, old, batch, token_rollup.inserts(rows))
    token_rollup.commit(spark, old, "4", token_rollup.inserts(rows.limit(0)))
    before = totals(spark, old)
    for _ in range(2):
        token_rollup.compact(spark, old, new, ["1", "2", "4"], "until-4")
    assert totals(spark, new) == totals(spark, old) == before
    assert spark.read.parquet(new).filter("batch = 'until-4' and docs > 0").count() == 2
    with pytest.raises(ValueError, match="settled"):
        token_rollup.commit(spark, new, "1", token_rollup.inserts(rows))
    token_rollup.commit(spark, new, "3", token_rollup.inserts(rows.limit(0)))
    assert totals(spark, new) == {("a", "en", "v1"): (2, 20), (None, None, "v1"): (2, 6)}
    token_rollup.compact(spark, new, newer, ["3", "until-4"], "all")
    assert totals(spark, newer) == totals(spark, new)
    with pytest.raises(ValueError, match="settled"):
        token_rollup.commit(spark, newer, "2", token_rollup.inserts(rows))
    with pytest.raises(ValueError, match="folder"):
        token_rollup.compact(spark, new, new, ["3"], "x")


@needs_tables
def test_rollup_query_equals_a_recount(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    expected = {}
    for d in docs:
        label, name, text = labels.get(d.doc_id), "byte_bpe_50k.json", d.text
        if label is not None and label.toxic == 1:
            continue
        if label is not None and label.toxic == 0 and label.quality == 1:
            name, text = name + " tidied", " ".join(x for x in re.split(r"[ \t\n\x0b\f\r]+", d.text) if x)
        key = (d.source, d.lang, name)
        n, tokens = expected.get(key, (0, 0))
        expected[key] = (n + 1, tokens + len(tokenizer().encode(text, add_special_tokens=False).ids))
    found = queries.op9_token_rollup(spark, SF_DIR).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in found} == expected


@needs_tables
@pytest.mark.parametrize("name", list(queries.sql()))
def test_query_matches_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF_DIR), queries.registered()[name], queries.sql()[name], SF_DIR) is None


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "exact_dedup", "minhash_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()}
            break
        assert after.columns == columns
        before, kept = ({r.doc_id for r in df.select("doc_id").collect()} for df in (docs, after))
        assert kept <= before
        if name == "language_id":
            assert kept == before
        if name == "toxicity":
            assert not any(labels.get(i) == 0 for i in before - kept)
        docs = after


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(3, 0, 1), (None, None, None)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        current = docs
        for name, stage in corpus_pipeline.STAGES:
            current = corpus_pipeline.stored(stage(spark, current, str(tmp_path)), name)
            if name != "packing":
                assert current.columns == docs.columns
        rows = current.collect()
        assert bool(rows) == (docs is odd_docs) and all(r.ids_crc32 >= 0 for r in rows)



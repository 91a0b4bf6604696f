"""Language and toxicity: held-out accuracy, odd input, repeatable training."""

import random
import zlib

import numpy as np

from marginalia.llm import language_id, queries, toxicity

SYLLABLES = {
    "aa": ["tho", "wer", "ing", "sha", "the", "ou"],
    "bb": ["eau", "que", "ié", "oux", "mé", "la"],
    "cc": ["sch", "üb", "ung", "ß", "kei", "der"],
}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def labelled(n, seed):
    rng = random.Random(seed)
    return [(sentence(rng, lang, rng.randint(5, 150)), lang) for _ in range(n) for lang in SYLLABLES]


def test_network_tells_languages_apart_and_trains_alike():
    rows = labelled(60, 1)
    network = language_id.train([t.encode() for t, _ in rows], [g for _, g in rows])
    again = language_id.train([t.encode() for t, _ in rows], [g for _, g in rows])
    assert np.array_equal(network.dense, again.dense)
    predict = network.predictor()
    # Numerals of any kind are no letters; a letter of an unknown script is one.
    assert {language_id._one(t, predict, network)[0] for t in ("²", "½ ①", "Ⅷ 3", "_ 12")} == {"und"}
    assert language_id._one("² 漢", predict, network)[0] != "und"
    found = [language_id._one(t, predict, network) for t, _ in labelled(40, 2)]
    right = [f[0] == g for f, (_, g) in zip(found, labelled(40, 2))]
    assert np.mean(right) > 0.97 and all(0 <= f[1] <= 1 for f in found)


def test_texts_in_no_known_language_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = language_id.fit(docs)
    rng = random.Random(9)

    def letters(first, n):
        return " ".join("".join(chr(first + rng.randrange(26)) for _ in range(rng.randint(2, 9))) for _ in range(n))

    strange = [letters(0x430, 300) for _ in range(20)]  # a script that was not learned
    en, fr = (docs.filter(f"lang = '{g}' and length(text) > 400").first().text for g in ("en", "fr"))
    known = [en, fr, en[:200] + " " + fr[:200], en + " " + fr, (en + " " + fr) * 200, en[:12], "Re."]
    rows = spark.createDataFrame(list(enumerate(known + strange)), "doc_id long, text string")
    kept = {r.doc_id for r in language_id.keep_identified(rows, network).collect()}
    assert set(range(len(known))) <= kept and len(kept) <= len(known) + 2
    assert language_id.keep_identified(rows, None).count() == 0


def test_tables_equal_the_convolution():
    rows = labelled(10, 3)
    network = language_id.train([t.encode() for t, _ in rows], [g for _, g in rows])
    x = np.concatenate([language_id.windows(t.encode()) for t, _ in rows[:3]])
    pooled = []
    for width, w in zip(language_id.WIDTHS, network.filters):
        e = network.embedding[x]
        stacked = np.concatenate([e[:, o : e.shape[1] - width + 1 + o] for o in range(width)], axis=2)
        pooled.append((stacked @ w).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + network.bias, 0)
    expected = language_id._softmax(hidden @ network.dense + network.dense_bias)
    assert np.allclose(network.predictor()(x), expected, atol=1e-4)


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 1000, 5000):
        text = bytes(i % 251 for i in range(n))
        found = language_id.windows(text)
        covered = b"".join(row[row != language_id.PAD].astype(np.uint8).tobytes()[: language_id._STEP] for row in found[:-1])
        assert (covered + found[-1][found[-1] != language_id.PAD].astype(np.uint8).tobytes()) == text
        assert language_id._sizes(text).sum() >= n


def test_languages_of_odd_texts(odd_docs, no_docs, odd_texts):
    network = language_id.fit(odd_docs)
    assert network.classes == ["en"]
    found = language_id.identify(odd_docs, network).collect()
    assert len(found) == len(odd_texts)
    no_letter = {0, 1, 2, 13}
    assert all((r.lang_pred == "und") == (r.doc_id in no_letter) for r in found)
    kept = language_id.keep_identified(odd_docs, network)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in odd_texts} - no_letter
    assert language_id.fit(no_docs) is None
    assert {r.lang_pred for r in language_id.identify(odd_docs, None).collect()} == {"und"}
    assert language_id.identify(no_docs, network).count() == 0


def toxic_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        toxic = i % 4 == 0
        words = sentence(rng, rng.choice(list(SYLLABLES)), rng.randint(20, 120)).split()
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumph", "zortig", "idiot"]) + rng.choice(["", "", "en"]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 7) for i, _, y in rows], "doc_id long, toxic int, label int")
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_of_held_out_rows(spark):
    docs, labels, truth = toxic_rows(spark)
    model = toxicity.fit(docs, labels.filter("doc_id % 3 <> 1"))
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held_out = [i for i in truth if i % 3 == 1]
    assert all(0 <= s <= 1 for s in scored.values()) and len(scored) == 600
    assert np.mean([(scored[i] >= toxicity.THRESHOLD) == truth[i] for i in held_out]) > 0.97
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == {i for i, s in scored.items() if s < toxicity.THRESHOLD}


def test_copies_make_no_evidence():
    rng = random.Random(6)
    texts, toxic = [], []

    def prose():
        return " ".join("".join(rng.choice("aeiklmnoprst") for _ in range(6)) for _ in range(80))

    copied = prose() + " quorx flumb"
    for i in range(300):
        texts.append(copied if i % 3 == 0 else prose() + (" grumph grumph" if i % 3 == 1 else ""))
        toxic.append(i % 3 < 2)
    model = toxicity.train(texts, np.array(toxic), np.full(300, 150.0))
    assert model.weights.get("grumph", 0) > 1 and "quorx" not in model.weights


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.3
    accuracy = [0.9, 0.8, 0.7, 0.85, 0.75]
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    votes[rng.random(votes.shape) < 0.3] = 0
    posterior, found = toxicity.label_model(votes, 0.3)
    assert np.allclose(found, accuracy, atol=0.08)
    assert ((posterior > 0.5) == truth).mean() > 0.9


def test_posterior_comes_from_the_voters():
    rng = np.random.default_rng(8)
    truth = rng.random(2000) < 0.2
    voters = np.stack([np.where(rng.random(2000) < a, truth, ~truth) * 2 - 1 for a in (0.97, 0.95, 0.96, 0.94)], axis=1)
    # An annotator who is wrong in a tenth of the texts is overruled, whatever the error.
    annotator = np.where(rng.random(2000) < 0.9, truth, ~truth)
    posterior, accuracies = toxicity.believed(voters, annotator)
    assert ((posterior > 0.5) != annotator).sum() > 150
    assert ((posterior > 0.5) == truth).mean() > 0.98 and abs(accuracies[-1] - 0.9) < 0.03


def test_query_of_toxicity_on_held_out_rows(spark, sf_dir):
    found = queries.op6_toxicity(spark, sf_dir).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    clean = [r.predicted for r in found if r.held_out and truth.get(r.doc_id) == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_a_repeated_labelled_id_gives_one_text(spark, monkeypatch):
    rows = [(1, f"text {i % 7}") for i in range(3000)] + [(1, None), (2, "b"), (2, "a"), (3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, sizes: (texts, toxic.tolist(), sizes.tolist()))
    texts, toxic, sizes = toxicity.fit(docs, labels)
    assert [*zip(texts, toxic, sizes)] == [("", True, 4.0), ("a", False, 2.0), ("a", True, 4.0), ("c", False, 2.0)]


def test_toxicity_of_odd_texts(spark, odd_docs, no_docs, odd_texts):
    one_class = spark.createDataFrame([(3, 0), (4, 0), (5, None)], "doc_id long, toxic int")
    assert toxicity.fit(odd_docs, one_class) is None
    assert {r.score for r in toxicity.score(odd_docs, None).collect()} == {0.0}
    docs, labels, _ = toxic_rows(spark)
    model = toxicity.fit(docs, labels)
    found = toxicity.score(odd_docs, model).collect()
    assert len(found) == len(odd_texts) and all(r.score < 0.5 for r in found)
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.keep_clean(odd_docs, model).columns == odd_docs.columns


def test_remainder_is_that_of_crc32(spark):
    from pyspark.sql import functions as F

    from marginalia.llm.samples import crc_remainder

    rows = spark.range(50).select("id", crc_remainder(F.col("id"), 3).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 3 for r in rows)

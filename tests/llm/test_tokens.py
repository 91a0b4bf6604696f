"""Ids of whole texts: parts looked up, the transducer, binary blocks, packed pieces."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginalia.llm import binary_ids, bpe_stream, packing
from marginalia.llm.tokens import library_encoder, tokenizer

PARTS = ["a", "the", "é", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "12", ".", "\u00a0", "\u3000", "漢字", "x" * 60, "\x1c", "\x85", "😀"]


def library_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def as_ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.fixture(scope="module")
def bpe():
    return bpe_stream._worker("byte_bpe_50k.json")[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), max_size=5))
def test_parts_give_the_ids_of_whole_texts(texts):
    assert [as_ids(raw) for raw in library_encoder().encode(texts)] == [library_ids(t) for t in texts]


def test_transducer_equals_the_library_in_blocks_of_any_size(bpe):
    rng = random.Random(1)
    for n in (1, 5, 40, 9000):
        for alphabet in ("ab", "aeinrst", "théreingo", "é漢ñ😀", "="):
            word = "".join(rng.choice(alphabet) for _ in range(n)).encode()
            expected = [i for w in bpe._words.findall(word.decode()) for i in bpe.transducer.encode([w.encode()])]
            assert expected == library_ids(word.decode())
            step = rng.randint(1, 5000)
            if len(bpe._words.findall(word.decode())) == 1:
                blocks = (word[i : i + step] for i in range(0, len(word), step))
                assert list(bpe.transducer.encode(blocks)) == expected == bpe.transducer.word(word)


def test_transducer_emits_before_the_word_ends(bpe):
    read = 0

    def blocks():
        nonlocal read
        for _ in range(100):
            read += 1
            yield b"thereing" * 128

    next(bpe.transducer.encode(blocks()))
    assert read * 1024 < 4 * (bpe.transducer.lookahead + bpe.transducer.longest)


def test_decoding_broken_ids_as_the_library_does(bpe):
    rng = random.Random(2)
    for _ in range(100):
        ids = [rng.randrange(50257) for _ in range(30)]
        assert "".join(bpe.decode(np.array(ids, "<u4"))) == tokenizer().decode(ids, skip_special_tokens=False)


def test_encode_and_decode_round_trip(odd_docs, no_docs, odd_texts):
    encoded = bpe_stream.encode(odd_docs)
    rows = encoded.collect()
    assert sorted((str(r.doc_id), as_ids(r.ids)) for r in rows) == sorted((str(i), library_ids(t)) for i, t in odd_texts)
    back = sorted((str(r.doc_id), r.text) for r in bpe_stream.decode(encoded).collect())
    assert back == sorted((str(i), t or "") for i, t in odd_texts)
    assert bpe_stream.round_trip_digests(bpe_stream.encode(no_docs)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 3))
def test_elias_fano_selects_every_value(steps, zeros):
    values = np.cumsum([0] * zeros + steps)
    found = binary_ids.EliasFano.from_bytes(binary_ids.EliasFano.build(values).to_bytes())
    assert found.all().tolist() == values.tolist() == [found.select(i) for i in range(found.n)]
    with pytest.raises(IndexError):
        found.select(found.n)


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(binary_ids.EliasFano.build(values).to_bytes()) * 8 < 10_000 * (2 + np.log2(1000) + 1.6)


def test_blocks_hold_all_documents_in_order(spark, odd_docs, no_docs, odd_texts, tmp_path):
    binary_ids.write_ids(odd_docs, f"{tmp_path}/ids", end_id=2, block_ids=50)
    assert binary_ids.read_blocks(spark, f"{tmp_path}/ids").count() > 3
    rows = sorted(binary_ids.read_ids(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd_texts), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    found = sorted(as_ids(r.ids) for r in rows)
    assert found == sorted(library_ids(t) + [2] for _, t in odd_texts)
    binary_ids.write_ids(no_docs, f"{tmp_path}/none", end_id=2)
    assert binary_ids.read_ids(spark, f"{tmp_path}/none").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    runs = packing.plan(counts, 64)
    held = np.zeros(65, int)
    for run in runs:
        assert run.times > 0 and sum(n * c for n, c in run.holds.items()) == 64 - run.room <= 64
        for n, c in run.holds.items():
            held[n] += c * run.times
    assert held.tolist() == counts.tolist()
    assert sum(r.times for r in runs) <= max(1, 1.25 * -(-sum(lengths) // 64) + 1) or sum(n > 32 for n in lengths) > 0


def test_plan_is_close_to_the_bound():
    lengths = np.minimum(2048, np.random.default_rng(0).lognormal(6, 1, 50_000).astype(int) + 1)
    used = sum(r.times for r in packing.plan(np.bincount(lengths, minlength=2049)))
    assert used <= 1.003 * -(-lengths.sum() // 2048)


def test_packed_pieces_are_gapless_and_whole(odd_docs, no_docs, odd_texts):
    packed = packing.pack(packing.encode_pieces(odd_docs, capacity=64), capacity=64)
    rows = packed.collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for i, text in odd_texts:
        expected = library_ids(text) + [0]
        own = sorted(by_doc[i], key=lambda r: r.start)[:: 2 if i == 9 else 1]  # doc 9 is there twice
        assert [x for r in own for x in as_ids(r.ids)] == expected
        assert all(r.length == 64 for r in own if r.piece > 0)
    joined = packing.sequences(packed).collect()
    assert len(joined) == len(by_sequence) and all(len(r.ids) == 4 * sum(r.lengths) for r in joined)
    assert packing.pack(packing.encode_pieces(no_docs)).count() == 0

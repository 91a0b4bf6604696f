"""Log probabilities of texts under a byte model that is learned from the table itself.

The model (see ``ppm``) is a trie of byte contexts over all training texts. It is never held
whole: its windows are dealt into parts by the latest two bytes of the context, and a part holds
all that scoring its windows needs, besides the 65,536 counts of byte pairs.

1. Documents are gathered into blocks where they lie. A block tells its distinct windows and
   words, each with its count in training texts, as one small binary per part.
2. Parts are merged over the blocks, by rounds of bounded groups.
3. The windows of every block meet the merged part: a score for each distinct one goes back.
4. A block with its scores gives the sums of its documents.

So neither texts nor positions move, only distinct windows of a block, and the compressed
words of its texts once. ``base_score`` is that of a word unigram model with one added to all counts.

NULL and empty texts have the end token alone. A NULL id is not held out. Repeated rows are learned and scored each. A
very long text is a block of its own and goes through the numbers in chunks. Without training texts all bytes are
alike. Columns other than ``doc_id``, ``text`` are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marginalia.llm import ppm
from marginalia.sources.paths import shared_folder, stored

BLOCK_BYTES = 16 << 20
# Blocks whose parts are merged in one group, and most parts there may be.
MERGED = 64
MOST_PARTS = 4096

_PIECE = "kind string, part int, block long, a binary, b binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bool], list[bytes], Counter[bytes]]]:
    """ids, held, streams of some ``BLOCK_BYTES`` of texts, and all their words, counted in training texts."""
    ids, held, streams, counts, size = [], [], [], Counter(), 0
    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "held", "text")]
        for doc_id, out, text in zip(*columns):
            data = text.as_py() or b""
            if ids and size + len(data) > BLOCK_BYTES:
                yield ids, held, streams, counts
                ids, held, streams, counts, size = [], [], [], Counter(), 0
            words = ppm.words_of(data)
            ids.append(doc_id.as_py())
            held.append(bool(out.as_py()))
            streams.append(ppm.stream_of(words))
            words.append(b"")
            counts.update(dict.fromkeys(words, 0) if held[-1] else words)
            size += len(data)
    if ids:
        yield ids, held, streams, counts


def _word_rows(counts: dict[bytes, int], parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """part, words, counts; the end token is the empty word."""
    dealt: list[list[bytes]] = [[] for _ in range(parts)]
    for word in sorted(counts):
        dealt[zlib.crc32(word) % parts].append(word)
    for part, words in enumerate(dealt):
        if words:
            yield part, ppm.pack_bytes(b"\n".join(words) + b"\n"), ppm.pack(np.array([counts[w] for w in words]))


def _words(data: bytes) -> list[bytes]:
    return ppm.unpack_bytes(data).split(b"\n")[:-1]


def _window_rows(keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    order, bounds = ppm.by_part(keys, parts)
    for part, (start, end) in enumerate(zip(bounds, bounds[1:])):
        if end > start:
            here = order[start:end]
            yield part, ppm.pack(keys[here], rising=True), ppm.pack(counts[here])


def _pieces(parts: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, held, streams, counts in _blocks(batches):
            known, n = ppm.count_windows([s for s, out in zip(streams, held) if not out])
            others, _ = ppm.count_windows([s for s, out in zip(streams, held) if out])
            keys, n = ppm.summed(np.concatenate([known, others]), np.concatenate([n, np.zeros(len(others), np.int32)]))
            rows = [("windows", *x) for x in _window_rows(keys, n, parts)]
            rows += [("words", *x) for x in _word_rows(counts, parts)]
            for kind, part, a, b in rows:
                one = {"kind": kind, "part": part, "block": block, "a": a, "b": b}
                yield pa.RecordBatch.from_pylist([one], schema)
            whole = {
                "kind": "docs", "part": 0, "block": block, "a": ppm.pack_bytes(b"".join(streams)),
                "ids": ids, "held": held, "sizes": [len(s) for s in streams],
            }
            yield pa.RecordBatch.from_pylist([whole], schema)
            block += 1

    return cut


def _merge(table: pa.Table) -> pa.Table:
    """Windows or words of one part with their training counts, added up; what training lacks goes."""
    kind, part, group = (table.column(c)[0].as_py() for c in ("kind", "part", "group"))
    cells = zip(table.column("a"), table.column("b"))
    if kind == "windows":
        found = [(ppm.unpack(a.as_py(), rising=True), ppm.unpack(b.as_py()).astype(np.int64)) for a, b in cells]
        keys, n = ppm.summed(np.concatenate([k for k, _ in found]), np.concatenate([x for _, x in found]))
        a, b = ppm.pack(keys[n > 0], rising=True), ppm.pack(n[n > 0])
    else:
        counts: Counter[bytes] = Counter()
        for a, b in cells:
            counts.update({w: n for w, n in zip(_words(a.as_py()), ppm.unpack(b.as_py()).tolist()) if n})
        a, b = ppm.pack_bytes(b"".join(w + b"\n" for w in counts)), ppm.pack(np.array(list(counts.values())))
    return pa.table(
        {"kind": [kind], "part": pa.array([part], pa.int32()), "block": pa.array([group], pa.int64()), "a": [a], "b": [b]}
    )


def _merged(pieces: DataFrame, blocks: int) -> DataFrame:
    """One row per kind and part. Groups are of ``MERGED`` blocks, then of as many groups."""
    # A task numbers its blocks from its partition, shifted: mix, so that groups are even.
    at = pieces.withColumn("block", F.xxhash64("block"))
    while True:
        blocks = -(-blocks // MERGED)
        at = at.withColumn("group", F.pmod("block", F.lit(blocks)))
        at = at.groupBy("kind", "part", "group").applyInArrow(_merge, _PIECE)
        if blocks <= 1:
            return stored(at, "lm-model")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """x, y, n: pairs of bytes of a part; for words the tokens (x = -1) and types (x = -2)."""
    for batch in batches:
        for kind, a, b in zip(*[batch.column(c).to_pylist() for c in ("kind", "a", "b")]):
            n = ppm.unpack(b).astype(np.int64)
            if kind == "words":
                rows = [[-1, -2], [0, 0], [int(n.sum()), len(n)]]
            else:
                keys = ppm.unpack(a, rising=True)
                pairs = keys >> ppm.U(8 * ppm.ORDER) << ppm.U(8) | keys & ppm.U(255)
                pairs, n = ppm.summed(pairs, n)
                rows = [(pairs >> ppm.U(8)).astype(np.int64), (pairs & ppm.U(255)).astype(np.int64), n]
            yield pa.record_batch([pa.array(r, pa.int64()) for r in rows], names=["x", "y", "n"])


def _look_up(pairs: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema(
        [("kind", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]
    )

    def look_up(asked: pa.Table, model: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return schema.empty_table()
        kind = asked.column("kind")[0].as_py()
        a, b = (model.column(c)[0].as_py() if model.num_rows else None for c in ("a", "b"))
        rows = []
        if kind == "windows":
            known = (ppm.unpack(a, rising=True), ppm.unpack(b).astype(np.int64)) if a else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            trie = ppm.Model(*known, pairs)
            for part, block, keys in zip(*[asked.column(c) for c in ("part", "block", "a")]):
                score = trie.log10(ppm.unpack(keys.as_py(), rising=True)).astype(np.float32)
                rows.append((kind, part.as_py(), block.as_py(), keys.as_py(), ppm.pack(score.view(np.uint32))))
        else:
            counts = dict(zip(_words(a), ppm.unpack(b).tolist())) if a else {}
            for part, block, words in zip(*[asked.column(c) for c in ("part", "block", "a")]):
                n = [counts.get(w, 0) for w in _words(words.as_py())]
                rows.append((kind, part.as_py(), block.as_py(), words.as_py(), ppm.pack(np.array(n))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return look_up


def _sum_up(total: int, types: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def sum_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        row = docs.to_pylist()[0]
        data, streams, start = ppm.unpack_bytes(row.pop("a")), [], 0
        for size in row["sizes"]:
            streams.append(data[start : start + size])
            start += size
        del data
        counts: dict[bytes, int | float] = {}
        keys, scores = [], []
        for kind, a, b in zip(*[answers.column(c) for c in ("kind", "a", "b")]):
            if kind.as_py() == "words":
                counts.update(zip(_words(a.as_py()), ppm.unpack(b.as_py()).tolist()))
            else:
                keys.append(ppm.unpack(a.as_py(), rising=True))
                scores.append(ppm.unpack(b.as_py()).astype(np.uint32).view(np.float32))
        unknown = {w for w, n in counts.items() if not n}
        log = counts  # in place: there are many words
        for word, n in counts.items():
            log[word] = math.log10((n + 1) / (total + types + 1))
        n_tokens, n_known, base = [], [], []
        for s in streams:
            words = s.split() + [b""]
            n_tokens.append(len(words))
            n_known.append(len(words) - sum(map(unknown.__contains__, words)) if unknown else len(words))
            base.append(math.fsum(map(log.__getitem__, words)))
        counts.clear()
        score = np.zeros(len(streams))
        every, values = np.concatenate(keys), np.concatenate(scores)
        del keys, scores
        order = np.argsort(every)
        every, values = every[order], values[order].astype(np.float64)
        del order
        # Windows sorted together with their stream's place in the chunk: each is looked up once.
        for first, keys, of in ppm.chunks(streams):
            keys = keys << ppm.U(8) | of
            keys.sort()
            window = keys >> ppm.U(8)
            starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            value = values[np.searchsorted(every, window[starts])]
            value = np.repeat(value, np.diff(np.r_[starts, len(window)]))
            sums = np.bincount((keys & ppm.U(255)).astype(np.int64), weights=value)
            score[first : first + len(sums)] += sums
        columns = [row["ids"], row["held"], n_tokens, n_known, [total] * len(streams), base, score]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return sum_up


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows that are held out are scored but not learned from. ``docs`` should come from a scan or
    a stored table: blocks follow its partitions.
    """
    rows = docs.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held"), F.col("text").cast("binary").alias("text")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = min(MOST_PARTS, max(16, size // BLOCK_BYTES // 2))
    id_type = docs.schema["doc_id"].dataType
    schema = f"{_PIECE}, ids array<{id_type.simpleString()}>, held array<boolean>, sizes array<long>"
    arrow = pa.schema(
        [("kind", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
         ("ids", pa.list_(to_arrow_type(id_type))), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))]
    )
    folder = shared_folder(docs.sparkSession, "lm-pieces")
    rows.mapInArrow(_pieces(parts, arrow), schema).write.partitionBy("kind").parquet(folder)
    stored_pieces = docs.sparkSession.read.schema(schema).parquet(folder)
    asked = stored_pieces.filter("kind <> 'docs'").select("kind", "part", "block", "a", "b")
    blocks = stored_pieces.filter("kind = 'docs'").select("block", "a", "ids", "held", "sizes")
    n_blocks = blocks.count()
    model = _merged(asked, max(1, n_blocks))
    # At most 65,536 pairs of bytes and two sums come to the driver.
    known = model.mapInArrow(_sizes, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
    pairs, total, types = np.zeros((256, 256), np.int64), 0, 0
    for x, y, n in known:
        if x >= 0:
            pairs[x, y] = n
        elif x == -1:
            total = n
        else:
            types = n
    # A merged part meets so many blocks at a time that its copies stay few.
    copies = max(1, -(-n_blocks // (4 * parts)))
    keys = ["kind", "part", "copy"]
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)))
    model = model.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)).cast("array<long>")))
    answers = (
        asked.drop("b").groupBy(*keys).cogroup(model.groupBy(*keys)).applyInArrow(_look_up(pairs), _PIECE)
    )
    out = pa.schema(
        [("doc_id", to_arrow_type(id_type)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _sum_up(total, types, out),
            f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )

"""Token ids as binary blocks with Elias-Fano document boundaries.

A block holds the ids of a run of documents, one after the other, and where each document
ends. The ends never decrease, so Elias-Fano coding stores them in about
``2 + log2(ids / documents)`` bits each: the low bits packed side by side, the high bits
in unary. A sample of the ones in the unary part, one position in every ``SAMPLE``,
lets ``select`` find the i-th end after a look at a few bytes; no table of 64-bit offsets is
kept anywhere.

Blocks are rows of a Parquet folder, because that is what Spark writes atomically to any
store: ``shard, block, first (ids before the block in its shard), n_ids, doc_ids, ends (Elias-Fano
bytes), width (bytes of an id), ids``. Shards are ranges of ``doc_id``; block after block and
shard after shard gives all documents in ascending ``doc_id`` order.

Defined cases: a NULL or empty text is a document of the end id alone; rows without
``doc_id`` come first; rows that repeat a ``doc_id`` are kept, in the order of their texts; an
empty table gives an empty folder; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.batches import pieces, texts_of
from marginalia.llm.tokens import TOKENIZER, library_encoder

SAMPLE = 64
BLOCK_IDS = 1 << 20

BLOCKS = "shard int, block int, first long, n_ids long, doc_ids array<long>, ends binary, width int, ids binary"
_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.binary()),
        ("width", pa.int32()),
        ("ids", pa.binary()),
    ]
)


class EliasFano:
    """A sequence of non-decreasing, non-negative integers in near-minimal space."""

    _HEADER = struct.Struct("<QQB")

    def __init__(self, n: int, bound: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bound, self.low_bits = n, bound, low_bits
        self._low, self._high, self._samples = low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bound = int(values[-1]) if n else 0
        low_bits = max(0, (bound // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little")
        return cls(n, bound, low_bits, low, high, ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = self._HEADER.pack(self.n, self.bound, self.low_bits)
        return head + self._samples.tobytes() + self._low.tobytes() + self._high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bound, low_bits = cls._HEADER.unpack_from(data)
        at = cls._HEADER.size
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
        at += samples.nbytes
        low = np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at)
        return cls(n, bound, low_bits, low, np.frombuffer(data, np.uint8, -1, at + low.nbytes), samples)

    def _low_of(self, i: int) -> int:
        start = i * self.low_bits
        end = start + self.low_bits
        word = int.from_bytes(self._low[start // 8 : -(-end // 8)].tobytes(), "little")
        return (word >> (start % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from 0: the sampled one before it, then bytes counted onwards."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self._samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        bits = int(self._high[byte]) >> (at % 8) << (at % 8)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self._high[byte])
        for _ in range(left):
            bits &= bits - 1
        position = byte * 8 + (bits & -bits).bit_length() - 1
        return (position - i) << self.low_bits | self._low_of(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self._low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return ((ones - np.arange(self.n)) << self.low_bits) + low


def _block(shard: int, block: int, first: int, doc_ids: list, parts: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), "<u4")
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    ends = EliasFano.build(np.cumsum([len(p) // 4 for p in parts]))
    row = [shard, block, first, len(ids), doc_ids, ends.to_bytes(), width, ids.astype(f"<u{width}").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS)], schema=_BLOCKS)


def _writer(tokenizer: str, end_id: int, block_ids: int) -> Callable[[Iterator], Iterator]:
    end = np.asarray([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        block = first = held = 0
        doc_ids, parts = [], []
        for piece in pieces(batches):
            found = encoder.encode(texts_of(piece))
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), found):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= block_ids:
                    yield _block(shard, block, first, doc_ids, parts)
                    block, first, held = block + 1, first + held, 0
                    doc_ids, parts = [], []
        if parts:
            yield _block(shard, block, first, doc_ids, parts)

    return encode


def write_ids(
    docs: DataFrame, folder: str, end_id: int, tokenizer: str = TOKENIZER, block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs`` (doc_id, text) and write the blocks to ``folder``, which must be new.

    Texts move once, to their range of ``doc_id``; a task then works through its range in
    order and holds one block of about ``block_ids`` ids.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )
    blocks = ordered.mapInArrow(_writer(tokenizer, end_id, block_ids), BLOCKS)
    blocks.write.option("compression", "zstd").parquet(folder)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(folder)


_SPANS = "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long, ids binary"


def _reader(with_ids: bool) -> Callable[[Iterator], Iterator]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("shard", pa.int32()),
            ("start_in_shard", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for piece in pieces(batches, "ids") for r in piece.to_pylist()):
            ends = EliasFano.from_bytes(row["ends"]).all()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
            spans = list(zip((4 * starts).tolist(), (4 * ends).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(ends), row["shard"], np.int32)),
                    pa.array(row["first"] + starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()),
                    pa.array([ids[a:b] if with_ids else None for a, b in spans], pa.binary()),
                ],
                schema=schema,
            )

    return decode


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked for, its ids as little-endian unsigned 32-bit integers.

    A shard's place among all ids comes from the shards' totals, one row per write task.
    """
    blocks = read_blocks(spark, folder)
    spans = blocks.mapInArrow(_reader(with_ids), _SPANS)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = sizes.select(
        "shard", F.expr("sum(n) over (order by shard rows between unbounded preceding and current row) - n").alias("before")
    )
    out = spans.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
    return out if with_ids else out.drop("ids")

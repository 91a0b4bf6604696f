"""Best-fit packing of documents into sequences by linear grouping.

Only whole documents longer than a sequence are cut: their first piece takes what full pieces
leave over. What has to be packed is then known from how many pieces have each length, a
table no longer than a sequence, and so is the plan:

1. Large lengths are put into ``GROUPS`` groups of equal cardinality and rounded up to the
   largest of their group, which leaves few sizes.
2. For the largest size left, the configuration of sizes that fills a sequence best is found
   (subset sums within the counts left) and used as often as the counts allow.
3. The actual lengths of a group, longest first, replace its rounded size. Sequences with the
   same lengths stay together as one run of the plan.
4. Small lengths, the longest first, go to the fullest sequences that still hold them.

Each piece gets a rank among the pieces of its length; rank and plan give its sequence and
offset. Ranks are numbered within salted parts of a length, whose sizes are summed up, so a
length that a third of all pieces share is spread over many tasks.

Defined cases: NULL and empty texts are a document of the end id alone; rows that repeat are
packed as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.batches import pieces as small_batches
from marginalia.llm.batches import texts_of
from marginalia.llm.tokens import TOKENIZER, library_encoder
from marginalia.sources.paths import stored

CAPACITY = 2048
GROUPS = 512
LARGE = 1 / 3
# Pieces of one length numbered by one task.
RANKED_TOGETHER = 500

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


@dataclass
class Run:
    """``times`` sequences alike: counts by length, and the room left."""

    times: int
    room: int
    holds: dict[int, int] = field(default_factory=dict)

    def put(self, length: int, count: int) -> None:
        self.holds[length] = self.holds.get(length, 0) + count
        self.room -= length * count

    def split(self, times: int) -> Run:
        self.times -= times
        return Run(times, self.room, dict(self.holds))


def _groups(counts: np.ndarray, first: int) -> list[list[list[int]]]:
    """Large pieces, longest first, in groups of equal cardinality: [length, count] lists."""
    total = int(counts[first:].sum())
    size = max(1, -(-total // GROUPS))
    groups: list[list[list[int]]] = []
    room = 0
    for length in range(len(counts) - 1, first - 1, -1):
        left = int(counts[length])
        while left:
            if not room:
                groups.append([])
                room = size
            taken = min(room, left)
            groups[-1].append([length, taken])
            room, left = room - taken, left - taken
    return groups


def _fill(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """Groups whose rounded sizes sum to as much of ``room`` as any choice can, by subset sums."""
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    by = np.full(room + 1, -1, np.int64)
    for g, size in enumerate(sizes):
        layer = reached.copy()
        for _ in range(min(left[g], room // size)):
            new = np.zeros(room + 1, bool)
            new[size:] = layer[:-size]
            new &= ~reached
            if not new.any():
                break
            by[new] = g
            reached |= new
            layer = new
        if reached[room]:
            break
    at = int(np.flatnonzero(reached)[-1])
    chosen = []
    while at:
        chosen.append(int(by[at]))
        at -= sizes[by[at]]
    return chosen


def _configurations(sizes: list[int], left: list[int], capacity: int) -> Iterator[tuple[int, list[int]]]:
    """(how often, groups) until nothing is left."""
    for g, size in enumerate(sizes):
        while left[g]:
            left[g] -= 1
            chosen = [g, *_fill(capacity - size, sizes, left)]
            left[g] += 1
            times = min(left[c] // chosen.count(c) for c in set(chosen))
            for c in chosen:
                left[c] -= times
            yield times, chosen


def _substitute(times: int, chosen: list[int], groups: list[list[list[int]]], capacity: int) -> Iterator[Run]:
    """Actual pieces for rounded ones; a run ends where any of its lengths does."""
    slots = []
    for g in chosen:
        need, slot = times, []
        while need:
            length, count = groups[g][0]
            taken = min(need, count)
            slot.append([length, taken])
            need -= taken
            if taken == count:
                groups[g].pop(0)
            else:
                groups[g][0][1] -= taken
        slots.append(slot)
    while slots[0]:
        alike = min(slot[0][1] for slot in slots)
        run = Run(alike, capacity)
        for slot in slots:
            run.put(slot[0][0], 1)
            slot[0][1] -= alike
            if not slot[0][1]:
                slot.pop(0)
        yield run


def _best_fit(runs: list[Run], length: int, count: int, capacity: int) -> None:
    """``count`` pieces into the fullest sequences that hold them, then into new ones.

    A sequence that has just taken one is fuller than before, so it takes the next one too.
    """
    for run in sorted((r for r in runs if r.room >= length), key=lambda r: r.room):
        if not count:
            return
        each = run.room // length
        whole = min(run.times, count // each)
        if whole:
            filled = run if whole == run.times else run.split(whole)
            if filled is not run:
                runs.append(filled)
            filled.put(length, each)
            count -= whole * each
            if filled is run:
                continue
        if count:
            last = run if run.times == 1 else run.split(1)
            if last is not run:
                runs.append(last)
            last.put(length, count)
            count = 0
    each = capacity // length
    for times, held in ((count // each, each), (1, count % each)):
        if times and held:
            run = Run(times, capacity)
            run.put(length, held)
            runs.append(run)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Run]:
    """Runs of sequences for ``counts[length]`` pieces of each length."""
    first_large = int(capacity * LARGE) + 1
    groups = _groups(counts, first_large)
    sizes = [group[0][0] for group in groups]
    left = [sum(n for _, n in group) for group in groups]
    runs = [
        run
        for times, chosen in _configurations(sizes, left, capacity)
        for run in _substitute(times, chosen, groups, capacity)
    ]
    for length in range(first_large - 1, 0, -1):
        if counts[length]:
            _best_fit(runs, length, int(counts[length]), capacity)
    return runs


@dataclass(frozen=True)
class Places:
    """The plan as arrays: where the pieces of a length with ranks from ``first`` on go."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, runs: list[Run]) -> Places:
        rows = []
        used: dict[int, int] = {}
        sequence = 0
        for run in runs:
            offset = 0
            for length, each in run.holds.items():
                rows.append((length, used.get(length, 0), each, sequence, offset))
                used[length] = used.get(length, 0) + each * run.times
                offset += length * each
            sequence += run.times
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets."""
        starts = np.searchsorted(self.length, length, "left")
        ends = np.searchsorted(self.length, length, "right")
        at = np.empty(len(length), np.int64)
        for value in np.unique(length):
            rows = length == value
            a, b = starts[rows][0], ends[rows][0]
            at[rows] = a + np.searchsorted(self.first[a:b], rank[rows], "right") - 1
        nth = rank - self.first[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the others."""
    first = total % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, total, capacity))]


def encode_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, tokenizer: str = TOKENIZER, with_ids: bool = True
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (little-endian unsigned 32-bit, or NULL)."""
    end = np.asarray([end_id], "<u4").tobytes()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for batch in small_batches(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                ids += end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), own if with_ids else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema
            )

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, _PIECES)


def _ranked(pieces: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``rank`` among the pieces of a length, from 0; ``sizes`` has length, n."""
    salted = pieces.join(F.broadcast(sizes), "length").withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / RANKED_TOGETHER).cast("long"))
    )
    parts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("part"))
    before = F.sum("part").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row"))
    return (
        salted.withColumn("nth", nth)
        .join(parts, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("nth") - 1)
        .drop("salt", "before", "nth", "n", "row")
    )


def _placer(places: Places) -> Callable[[Iterator], Iterator]:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            sequence, offset = places.find(length, rank)
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces, which have a ``length`` of 1 to ``capacity``.

    The pieces are stored once, because counting, ranking and placing read the same rows. What
    the driver sees is one count for each length.
    """
    kept = pieces.columns
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    found = [(r["length"], r["n"]) for r in sizes.collect()]
    for length, n in found:
        counts[length] = n
    sizes = pieces.sparkSession.createDataFrame(found, "length long, n long")
    places = Places.of(plan(counts, capacity))
    ranked = _ranked(pieces, sizes).select(*kept, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*kept).schema)
    return ranked.mapInArrow(_placer(places), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids and lengths in order, ids: one row for each sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
        F.aggregate(F.col("parts.ids"), F.unhex(F.lit("")), lambda a, b: F.concat(a, b)).alias("ids"),
    )

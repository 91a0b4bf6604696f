"""Prediction by partial matching over bytes: the numbers of the model, in numpy.

A text is a stream of lower-cased words, each with a space behind it, and one END. A *window* is a symbol with the ``ORDER``
bytes before it, packed into an integer: the latest byte of the context first, the symbol last.
Cutting a window short gives its place at every lower order of the trie, and windows that agree in the two latest bytes
of their context share all nodes of order two and more, so one part of the trie can be
scored without the others.

A symbol is predicted by the longest context that has been seen. If it never followed there, the
model escapes to the next shorter one, with the weight of as many occurrences as the
context has different symbols (method C); symbols of the longer context are excluded below. Under
order 0 all bytes not excluded are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ORDER = 6
END = b"\n"  # white space, hence in no word; also stands before the start
_PAD = END * ORDER
CHUNK = 1 << 21

U = np.uint64
_BYTE = U(255)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; ``bytes`` methods know the ASCII letters and white space only."""
    return text.lower().split()


def stream_of(words: list[bytes]) -> bytes:
    return b" ".join(words) + (b" " if words else b"") + END


def chunks(streams: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """first, windows, stream: windows of some streams, at most 256 and some ``CHUNK`` bytes at a
    time; ``stream`` counts from ``first``. A longer stream comes in several chunks."""
    first = 0
    while first < len(streams):
        last, size = first, 0
        while last < len(streams) and last - first < 256 and (last == first or size + len(streams[last]) <= CHUNK):
            size += len(streams[last])
            last += 1
        if size <= 2 * CHUNK:
            data = _PAD + _PAD.join(streams[first:last])
            lengths = np.array([len(s) for s in streams[first:last]])
            keys = _windows(data)
            # What was coded, not the padding between streams.
            of = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
            gap = np.repeat(np.arange(len(lengths)) * ORDER, lengths)
            yield first, keys[np.arange(size) + gap], of
        else:
            data = _PAD + streams[first]
            for start in range(0, size, CHUNK):
                keys = _windows(data[start : start + CHUNK + ORDER])
                yield first, keys, np.zeros(len(keys), np.uint64)
        first = last


def _windows(data: bytes) -> np.ndarray:
    n = len(data) - ORDER
    # Eight bytes from each place on, the oldest of the context lowest, the symbol at 48 bits.
    eight = np.ndarray((n,), "<u8", data + b"\0", 0, (1,)).astype(np.uint64)
    key = eight << U(8)
    key &= U(0xFFFFFFFFFFFF00)
    eight >>= U(48)
    eight &= _BYTE
    key |= eight
    return key


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def count_windows(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted windows and their numbers; never much more than these are held at once."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))]
    held = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))

    for _, keys, _ in chunks(streams):
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        found.append((keys[starts], np.diff(np.r_[starts, len(keys)]).astype(np.int32)))
        held += len(starts)
        if held > CHUNK // 2:
            found, held = [merged()], 0
    return merged()


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """By the two latest bytes of the context."""
    latest = keys >> U(8 * (ORDER - 1))
    return ((latest * U(40503) & U(0xFFFF)) % U(parts)).astype(np.uint16)


def by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """order, bounds: where the keys of each part stand, ascending inside it."""
    part = part_of(keys, parts)
    return np.argsort(part, kind="stable"), np.r_[0, np.cumsum(np.bincount(part, minlength=parts))]


# --- numbers as small binaries ----------------------------------------------------------


def pack(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed; of rising ones the steps."""
    values = np.asarray(numbers).astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=U(0))
    planes = values.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, rising: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], n * 8, codec="zstd", asbytes=True)
    values = np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view(np.uint64).reshape(n)
    return np.cumsum(values, dtype=np.uint64) if rising else values


def pack_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_bytes(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


# --- the trie ---------------------------------------------------------------------------


class _Level:
    """Nodes of one order: counts of (context, symbol), and of each context its total, its number
    of symbols, and what its symbols amount to one order below (for the exclusion)."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray, below: "_Level | _Low"):
        self.order, self.keys, self.counts = order, keys, counts
        contexts = keys >> U(8)
        starts = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.contexts = contexts[starts]
        self.symbols = np.diff(np.r_[starts, len(keys)])
        if len(keys):
            self.totals = np.add.reduceat(counts, starts)
            self.excluded = np.add.reduceat(below.count(_shorter(keys)), starts)
        else:
            self.totals = self.excluded = np.zeros(0, np.int64)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _find(self.keys, keys, self.counts)

    def context(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        at = keys >> U(8)
        return tuple(_find(self.contexts, at, x) for x in (self.totals, self.symbols, self.excluded))


class _Low:
    """Orders 1 and 0, from the counts of all 65,536 pairs of bytes."""

    def __init__(self, order: int, pairs: np.ndarray):
        self.order = order
        single = pairs.sum(0)
        self.counts = pairs if order == 1 else single[None, :]
        self.totals = self.counts.sum(1)
        self.symbols = (self.counts > 0).sum(1)
        self.excluded = ((self.counts > 0) * single[None, :]).sum(1) if order == 1 else 0 * self.totals

    def _row(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U(8)).astype(np.int64) if self.order else np.zeros(len(keys), np.int64)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return self.counts[self._row(keys), (keys & _BYTE).astype(np.int64)]

    def context(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        row = self._row(keys)
        return self.totals[row], self.symbols[row], self.excluded[row]


def _find(table: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of keys in a sorted table, 0 where absent."""
    if not len(table):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0)


def _shorter(keys: np.ndarray) -> np.ndarray:
    """A window without the oldest byte of its context."""
    return keys >> U(16) << U(8) | keys & _BYTE


class Model:
    """One part of the trie, from its distinct windows and their counts in training, and from the
    counts of all pairs of neighbouring bytes (``pairs[latest, symbol]``)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray):
        tables = [(keys, counts)]
        while len(tables) < ORDER - 1:
            tables.append(summed(_shorter(tables[-1][0]), tables[-1][1]))
        self.levels: list[_Level | _Low] = [_Low(0, pairs), _Low(1, pairs)]
        for order, (k, n) in enumerate(reversed(tables), 2):
            self.levels.append(_Level(order, k, n, self.levels[-1]))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each window's symbol after its context."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        less_total, less_symbols = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        short = keys
        for level in reversed(self.levels):
            total, symbols, excluded = level.context(short)
            weight = (total - less_total) + (symbols - less_symbols)
            count = level.count(short)
            hit = count > 0
            share = np.where(hit, count, symbols - less_symbols) / np.maximum(weight, 1)
            # Nothing was seen here that is not excluded: no symbol to find, and the escape is free.
            out[left] += np.log10(np.where(weight > 0, share, 1.0))
            on = ~hit
            left, short = left[on], _shorter(short[on])
            less_total, less_symbols = excluded[on], symbols[on]
        out[left] -= np.log10(256 - less_symbols)
        return out

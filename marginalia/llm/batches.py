"""Arrow batches in small pieces, so that Python never holds more than a few texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, NULL as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()

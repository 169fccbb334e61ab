"""Arrow batches in bounded pieces, and tables of what has already been segmented."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20
TABLE_ENTRIES = 250_000


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of about ``limit`` bytes of ``column``; one long value is a batch of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    # a worker lives on for other tasks and gives back what this one no longer needs
    pa.default_memory_pool().release_unused()


def numbered(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns named by their place, and the new name of each; no name of theirs clashes with an added one."""
    names = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    return rows.select(*[rows[f"`{c}`"].alias(n) for c, n in names.items()]), names


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null is empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


class SeenTable(dict):
    """Distinct chunk to its segmentation, filled in batches; emptied when it is full, so memory is bounded."""

    def __init__(self, segment: Callable[[list], list], entries: int = TABLE_ENTRIES) -> None:
        super().__init__()
        self.segment, self.entries = segment, entries

    def cover(self, chunks: list) -> None:
        wanted = set(chunks)
        new = list(wanted.difference(self))
        if not new:
            return
        if len(self) + len(new) > self.entries and len(self):
            self.clear()
            new = list(wanted)
        self.update(zip(new, self.segment(new)))


def lists_of(values: list[bytes], kind: pa.DataType) -> pa.ListArray:
    """One list per value, the values being little-endian numbers of that kind."""
    width = kind.bit_width // 8
    ends = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) // width for v in values], out=ends[1:])
    flat = pa.Array.from_buffers(kind, int(ends[-1]), [None, pa.py_buffer(b"".join(values))])
    return pa.ListArray.from_arrays(pa.array(ends), flat)

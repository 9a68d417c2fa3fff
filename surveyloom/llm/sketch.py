"""Mergeable counting sketches: every task counts its own rows in one small array, the
arrays are added segment by segment, and the sum is bounded whatever the input holds."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value

ship_by_value(__name__)

SEGMENT = 1 << 16
SCHEMA = "segment int, counts binary"


def cells_for(rows: int, per_row: int, most: int) -> int:
    """A power of two near ``per_row`` cells a row, at least one segment, at most ``most``."""
    return min(most, max(SEGMENT, 1 << max(0, rows * per_row - 1).bit_length()))


class Counter:
    """Saturating counts in ``cells`` cells of an unsigned type."""

    def __init__(self, cells: int, kind=np.uint8):
        self.counts = np.zeros(cells, dtype=kind)
        self.top = np.iinfo(kind).max

    def add(self, spots: np.ndarray) -> None:
        found, times = np.unique(spots, return_counts=True)
        self.counts[found] = np.minimum(self.counts[found].astype(np.int64) + times, self.top)

    def segments(self) -> Iterator[pa.RecordBatch]:
        """One row per segment that holds a count."""
        for k in range(0, len(self.counts), SEGMENT):
            part = self.counts[k:k + SEGMENT]
            if part.any():
                # a small task leaves most cells at nothing: packed, it costs what it counted
                yield pa.RecordBatch.from_arrays([pa.array([k // SEGMENT], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                                                 names=["segment", "counts"])


def merged(parts: DataFrame, kind=np.uint8, reduce: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> dict[int, bytes]:
    """Adds the segments of all tasks and returns each as ``reduce`` leaves it.

    A task adds the segments dealt to it while they stream in and holds one array for
    each, never the list of them."""
    top = np.iinfo(kind).max

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zlib.decompress(counts.as_buffer()), dtype=kind).astype(np.int64)
                sums[segment] = np.minimum(part + sums[segment], top) if segment in sums else part
        for segment, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([reduce(total.astype(kind))], pa.binary())],
                                             names=["segment", "counts"])

    rows = parts.repartition(F.col("segment")).mapInArrow(add, SCHEMA).collect()
    return {r["segment"]: bytes(r["counts"]) for r in rows}

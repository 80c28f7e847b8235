"""Passes over a table that end in one small array of sums.

Each task adds its batches into an array of a fixed shape, a few tasks add
those arrays, and the driver adds the few that are left: what it receives
follows the shape alone, not the rows or the number of tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm.base import world

MOST_ADDERS = 16
#: Entries of a matrix that are worked on at once in a task.
SLICE_ENTRIES = 1 << 20


def slices(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Consecutive rows, about ``SLICE_ENTRIES`` entries at once."""
    step = max(1, SLICE_ENTRIES // max(1, rows.shape[1]))
    for a in range(0, len(rows), step):
        yield rows[a : a + step]


def summed(rows: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], shape: tuple[int, ...], kind: type = np.float64) -> np.ndarray:
    """The sum over all batches of what ``add(batch, total)`` adds to ``total``.
    Whole numbers have to stay within 64 bits."""
    item = "double" if kind is np.float64 else "long"
    size = int(np.prod(shape))
    arrow = pa.list_(pa.float64() if kind is np.float64 else pa.int64())

    def row(total: np.ndarray) -> pa.RecordBatch:
        flat = pa.array(total.reshape(-1))
        return pa.record_batch([pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), flat).cast(arrow)], names=["total"])

    def each(batches):
        total = np.zeros(shape, kind)
        for batch in batches:
            add(batch, total)
        yield row(total)

    def together(batches):
        total = np.zeros(size, kind)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += flat.reshape(-1, size).sum(axis=0)
        yield row(total)

    schema = f"total array<{item}>"
    parts = rows.mapInArrow(each, schema).repartition(min(MOST_ADDERS, world(rows.sparkSession))).mapInArrow(together, schema)
    total = np.zeros(size, kind)
    for r in parts.collect():
        total += np.array(r["total"], kind)
    return total.reshape(shape)

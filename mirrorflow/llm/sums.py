"""Sums of numpy arrays over all rows of a table, added up in tasks before they reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ADDERS = 8


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix with a row per list."""
    d = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def table_sums(rows: DataFrame, length: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of what ``part`` makes of each Arrow batch, an array of ``length`` numbers.

    Each task yields one array; ``ADDERS`` tasks add them up, and as many arrays reach the driver.
    """

    def packed(total: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        yield packed(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += matrix(batch.column(0)).sum(axis=0)
        yield packed(total)

    parts = rows.mapInArrow(run, "s array<double>").repartition(ADDERS).mapInArrow(add, "s array<double>")
    return sum((np.array(row["s"]) for row in parts.collect()), np.zeros(length))

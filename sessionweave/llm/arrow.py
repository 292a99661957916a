"""Small helpers for operators that stream Arrow batches through Python."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of one Arrow batch handed to Python; bounds a worker's memory however
#: long single texts are (a batch always holds one row at least).
BATCH_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Cap Arrow batches by bytes, so that very long texts cannot pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.to_pylist()]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys, with the length appended."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup key-sorted batches so that no run of equal keys is cut in two.

    Only the last run of a batch is held back, so memory is that of a batch
    and of the largest run; callers bound their runs.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        last = [table[k][table.num_rows - 1].as_py() for k in keys]
        same = np.ones(table.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= table[k].to_numpy() == v
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()

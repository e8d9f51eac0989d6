"""Embeddings as integer vectors, kept as little-endian 32-bit binaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components must lie below this, so that inner products and squared distances of vectors of up to
#: 64 components are exact in a double and fit a long.
LIMIT = 1 << 22


def usable(vector: Column) -> Column:
    """There, without NULL, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(rows: DataFrame, keep: list[str], scale: int, column: str = "embedding", width: int | None = None) -> DataFrame:
    """``keep`` and ``q``: every component x as floor(scale * x), x as a double.

    Rows whose vector is not ``usable`` take no part, nor do vectors of another length than ``width`` (if
    given) or with a scaled component of LIMIT or more, whose scores would not fit a long.
    """
    rows = rows.where(usable(F.col(column)))
    if width is not None:
        rows = rows.where(F.size(column) == width)
    rows = rows.select(*keep, F.col(column).cast("array<double>").alias("_v"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(len(keep))
            at = np.asarray(listed.offsets, np.int64)
            q = np.floor(np.asarray(listed.flatten(), np.float64) * scale)
            fits = np.abs(q) < LIMIT
            bad = np.flatnonzero(~fits)
            fine = np.ones(len(listed), bool)
            fine[np.searchsorted(at - at[0], bad, "right") - 1] = False
            data = np.where(fits, q, 0).astype("<i4").tobytes()
            binary = pa.Array.from_buffers(
                pa.large_binary(), len(listed), [None, pa.py_buffer((at - at[0]) * 4), pa.py_buffer(data)]
            ).cast(pa.binary())
            out = pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], binary], [*keep, "q"])
            yield out if fine.all() else out.filter(pa.array(fine))

    return rows.mapInArrow(run, f"{fields}, q binary")


def matrix(binaries: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as doubles, shorter ones filled with zeros."""
    if not len(binaries):
        return np.zeros((0, width))
    lengths = np.asarray(pa.compute.binary_length(binaries), np.int64) // 4
    parts = b"".join(binaries.to_pylist())
    flat = np.frombuffer(parts, "<i4")
    if (lengths == width).all():
        return flat.reshape(-1, width).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, those with the smallest hash of ``key``: the same for the same table."""
    return rows.orderBy(F.xxhash64(key), key).limit(size)

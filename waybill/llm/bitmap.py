"""Bitmaps of hashed keys: gathered by Spark, small enough for every worker, wrong only by saying yes too often."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def marked(keys: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], most_bits: int = 28) -> tuple[int, np.ndarray]:
    """Bits (as a power of two, sixteen a key and at most ``most_bits``) and a bitmap of keys.

    ``hashes`` gives 64 bits for each row of a batch of keys. More keys fill the bitmap further, so
    that more of what is looked up passes in vain.
    """
    bits = min(most_bits, max(16, (16 * keys.count()).bit_length()))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(hashes(batch) >> np.uint64(64 - bits)).astype(np.int64)
            bounds = np.searchsorted(at >> (bits - 6), np.arange(65))
            there = np.flatnonzero(np.diff(bounds))
            yield pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int32()), pa.array([(at[bounds[s] : bounds[s + 1]] - (int(s) << (bits - 6))).tobytes() for s in there], pa.binary())], names=["range", "cells"]
            )

    def put(rows: pa.Table) -> pa.Table:
        own = np.zeros(1 << (bits - 6), bool)
        for x in rows.column("cells").to_pylist():
            own[np.frombuffer(x, np.int64)] = True
        return pa.table([rows.column("range").slice(0, 1), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["range", "bitmap"])

    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (bits - 9)
    for row in keys.mapInArrow(cells, "range int, cells binary").groupBy("range").applyInArrow(put, "range int, bitmap binary").collect():
        bitmap[row["range"] * size : (row["range"] + 1) * size] = np.frombuffer(row["bitmap"], np.uint8)
    return bits, bitmap


def among(hashes: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash is marked."""
    at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

"""A bit filter of fixed size over 64-bit hashes, to drop rows early that a later exact join would drop.

It has ``BITS`` bits whatever the input; a full filter lets everything pass, so only time depends on it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(20)).astype(np.int64) % BITS


def build(hashes: DataFrame, column: str) -> bytes:
    """The filter of a long column of mixed hashes, ORed over the partitions."""
    def run(batches):
        bits = np.zeros(BITS, bool)
        for batch in batches:
            bits[_bit(batch.column(0).to_numpy())] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])
    out = np.zeros(BITS // 64, np.int64)
    rows = hashes.select(column).where(F.col(column).isNotNull()).mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    for r in rows.collect():  # BITS / 64 rows at most
        out[r["at"]] = r["word"]
    return out.tobytes()


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether the filter (as uint8 array) may hold it."""
    bit = _bit(hashes)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

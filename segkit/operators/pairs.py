"""All pairs of rows, a block of rows against a block of rows, with nothing replicated.

The rows are packed once into blocks (binary matrices) and written to the shared folder.  A Cartesian product of that table with itself
streams every left partition past every right one: a task reads its two partitions from the folder, so what is shuffled and written grows
with the rows, while the comparisons grow with their square, as all pairs do.  A partition holds about ``PARTITION_BYTES``, which bounds
what the product keeps of the right side; a task holds one Arrow batch of pairs and one slice of distances (``SLICE_ROWS`` x block).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.operators.kmeans import arrow_matrix
from segkit.session import scratch_path

SLICE_ROWS = 256                  # rows of a slice of the distance matrix
BLOCK_BYTES = 2 << 20             # a block's matrix is no larger, whatever its dimension
PARTITION_BYTES = 32 << 20        # matrices of one partition
LISTS = {"bigint": pa.list_(pa.int64()), "string": pa.list_(pa.string())}


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again.  A checkpoint would carry the plan's constraints into the next round, where they
    multiply."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(rows: int, block_rows: int, d: int, cores: int) -> int:
    """Partitions of the packed table: enough pairs of them for the cores, none above ``PARTITION_BYTES``, none without a block."""
    wanted = max(math.isqrt(4 * cores), math.ceil(rows * d * 8 / PARTITION_BYTES))
    return max(1, min(wanted, math.ceil(rows / block_rows)))


def packed_blocks(rows: DataFrame, features: str, key: str, longs: list, n: int, d: int, block_rows: int, coded: dict | None = None) -> DataFrame:
    """(b, x, key, *longs) and per ``coded`` column ``c`` (c_v, c_c): blocks of up to ``block_rows`` of the ``n`` rows in the key's order.

    The key (a long) and ``longs`` are binary vectors; a coded column (its type bigint or string) is its values in the block and each row's place there.
    """
    coded = coded or {}
    size = max(1, min(block_rows, BLOCK_BYTES // (8 * max(d, 1))))
    names = [key, *longs]

    def fn(batches):
        for batch in batches:
            batch = batch.take(pa.array(np.argsort(batch.column(1).to_numpy(), kind="stable")))
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                out = {"x": pa.array([arrow_matrix(part.column(0), d).tobytes()], pa.binary())}
                for i, c in enumerate(names, 1):
                    out[c] = pa.array([part.column(i).to_numpy().astype(np.int64, copy=False).tobytes()], pa.binary())
                for i, (c, kind) in enumerate(coded.items(), 1 + len(names)):
                    if part.column(i).null_count:
                        raise ValueError(f"null in {c}")
                    codes = part.column(i).dictionary_encode()
                    out[f"{c}_v"] = pa.array([codes.dictionary.to_pylist()], LISTS[kind])
                    out[f"{c}_c"] = pa.array([codes.indices.to_numpy().astype(np.int64).tobytes()], pa.binary())
                yield pa.RecordBatch.from_pydict(out)
    schema = ", ".join(["x binary", *[f"{c} binary" for c in names], *[f"{c}_v array<{kind}>, {c}_c binary" for c, kind in coded.items()]])
    spread = rows.select(F.col(features).cast("array<double>").alias("x"), *names, *coded).repartition(
        partitions(n, size, d, rows.sparkSession.sparkContext.defaultParallelism), key)
    return written(spread.mapInArrow(fn, schema).withColumn("b", F.monotonically_increasing_id()), "pair-blocks")


def block_pairs(blocks: DataFrame, left: list, right: list, others: DataFrame | None = None) -> DataFrame:
    """(l_b, r_b, l_*, r_*): every block with every block, or with every block of ``others``."""
    mine = blocks.select(*[F.col(c).alias(f"l_{c}") for c in ["b", *left]])
    others = blocks if others is None else others
    return mine.join(others.select(*[F.col(c).alias(f"r_{c}") for c in ["b", *right]]).hint("shuffle_replicate_nl"))


def records(batches) -> Iterator[dict]:
    """The rows of Arrow batches; binary values are buffers, not copied."""
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(c) for c in names]
        for i in range(batch.num_rows):
            yield {c: v.as_buffer() if pa.types.is_binary(v.type) else v for c, v in zip(names, (col[i] for col in columns))}


def matrix(buffer, d: int) -> np.ndarray:
    return np.frombuffer(buffer, np.float64).reshape(-1, d)


def longs(buffer) -> np.ndarray:
    return np.frombuffer(buffer, np.int64)


def squares(X: np.ndarray, Y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, squared distances of ``SLICE_ROWS`` rows of X to all rows of Y), slice by slice."""
    yn = (Y ** 2).sum(1)
    for a in range(0, len(X), SLICE_ROWS):
        part = X[a:a + SLICE_ROWS]
        G = part @ Y.T
        G *= -2.0
        G += (part ** 2).sum(1)[:, None]
        G += yn[None, :]
        yield a, np.maximum(G, 0.0, out=G)

"""Hash-of-key pseudo-random draws.

A draw depends only on (salt, key), never on partitioning or row order, so the
same rows come out on 1 or 1,000 executors and in any SQL engine that has md5:

    h32(salt, key) = first 8 hex digits of md5("<salt>:<key>") as an unsigned int
    u(salt, key)   = h32 / 2^32                      in [0, 1)
    h(salt, key, m) = h32 mod m                      in {0 .. m-1}
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def h32(salt: str, key: Column | str) -> Column:
    k = F.concat(F.lit(f"{salt}:"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def uniform(salt: str, key: Column | str) -> Column:
    return h32(salt, key) / F.lit(TWO_32)


def bucket(salt: str, key: Column | str, m: int) -> Column:
    return h32(salt, key) % F.lit(m)


def hash_rank_key(salt: str, key: Column | str) -> Column:
    """Full md5 text used as a deterministic sort key (sampling, shuffles)."""
    return F.md5(F.concat(F.lit(f"{salt}:"), _col(key).cast("string")))


def uniform_np(hashes, seed: int, turn: int):
    """Numbers in [0, 1) from int64 hashes, one stream per (seed, turn), inside Arrow tasks."""
    import numpy as np
    x = hashes.view(np.uint64) + np.uint64((seed * 2654435761 + turn * 40503 + 12345) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53

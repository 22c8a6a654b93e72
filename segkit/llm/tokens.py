"""Words of UTF-8 texts as 64-bit hashes, straight from Arrow buffers.

``words_of`` lower-cases A-Z, cuts every text at separator bytes and hashes each word
with a positional polynomial over the bytes (one prefix sum, no Python object per word).
Texts are worked through in pieces of ``PIECE`` bytes cut at separators, so the temporary
arrays stay small however long a text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_B
    return x ^ (x >> np.uint64(31))


def _lower_lut() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


def space_words() -> np.ndarray:
    """Byte table for words ``[^\\x20\\x09-\\x0D]+``: separators map to 0, A-Z to a-z.

    NUL belongs to a word here, so it maps to 255 (a byte that UTF-8 never uses).
    """
    lut = _lower_lut()
    lut[0] = 255
    lut[9:14] = 0
    lut[32] = 0
    return lut


def letter_digit_words() -> np.ndarray:
    """Byte table for words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing."""
    lut = _lower_lut()
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[128:] = True
    lut[~keep[lut]] = 0
    return lut


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Holds the tables of one word definition; one per task."""

    def __init__(self, lut: np.ndarray, seed: int = 7):
        self.lut = lut
        self.byte_hash = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = 0x5851F42D4C957F2D
        self.inverse = pow(self.base, -1, 1 << 64)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = self.lut[data]
        word = np.zeros(len(x) + 2, np.int8)
        word[1:-1] = x != 0
        edges = np.flatnonzero(np.diff(word))
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            return starts, ends, np.zeros(0, np.uint64)
        if len(x) > len(self.up):
            self._grow(max(len(x), 2 * len(self.up)))
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(self.byte_hash[x] * self.up[:len(x)], out=sums[1:])
        return starts, ends, mix((sums[ends] - sums[starts]) * self.down[starts])

    def words_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, doc offsets, start byte, end byte, bytes) of an Arrow string array; null has no words.

        Words of text i are ``hashes[offsets[i]:offsets[i + 1]]``; start and end index the bytes.
        """
        col = texts.cast(pa.large_string()).fill_null("")
        col = pc.binary_join_element_wise(col, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        n = len(col)
        bounds = np.frombuffer(col.buffers()[1], np.int64, n + 1 + col.offset)[col.offset:] if n else np.zeros(1, np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8) if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
        data = data[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            while end < len(data):  # to the next separator, so that no word is cut
                cut = np.flatnonzero(self.lut[data[end:end + 4096]] == 0)
                if len(cut):
                    end += int(cut[0]) + 1
                    break
                end = min(len(data), end + 4096)
            s, e, h = self._piece(data[at:end])
            parts.append((s + at, e + at, h))
            at = end
        if parts:
            starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
        else:
            starts = ends = np.zeros(0, np.int64)
            hashes = np.zeros(0, np.uint64)
        return hashes, np.searchsorted(starts, bounds), starts, ends, data


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Cuts a batch into slices whose texts hold about ``limit`` bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, first = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(first, i - first)
            total, first = 0, i
        total += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 with the same bits (Spark has no unsigned long)."""
    return np.ascontiguousarray(x).view(np.int64)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive segments, empty ones included."""
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]

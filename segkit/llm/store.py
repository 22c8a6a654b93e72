"""Arrays that tasks write to the shared folder and workers map into memory.

``spark.checkpoint.dir`` names the folder.  Where it is a mounted folder (``file:``), workers map its
files straight away.  Where it is another store, files go there through pyarrow and come back to every
executor with ``SparkContext.addFile``.
"""

from __future__ import annotations

import os
import uuid

import numpy as np

from segkit.session import scratch_path


def model_folder(spark, name: str) -> str:
    uri = scratch_path(spark, name)
    if uri.startswith("file:") or "://" not in uri:
        uri = "/" + uri.removeprefix("file:").lstrip("/")
        os.makedirs(uri, exist_ok=True)
    return uri


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Writes folder/name.npy; a repeated task writes the same bytes again."""
    if "://" not in folder:
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, array)
        os.replace(part, f"{folder}/{name}.npy")
        return
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_output_stream(f"{path}/{name}.npy") as f:
        np.save(f, array)


def publish(spark, folder: str) -> str:
    """What workers open: the mounted folder, or the name under which Spark ships it."""
    if "://" not in folder:
        return folder
    spark.sparkContext.addFile(folder, recursive=True)
    return "shipped:" + folder.rstrip("/").rsplit("/", 1)[1]


def load(handle: str, name: str) -> np.ndarray:
    """The array, mapped read-only."""
    if handle.startswith("shipped:"):
        from pyspark import SparkFiles
        handle = SparkFiles.get(handle.removeprefix("shipped:"))
    return np.load(f"{handle}/{name}.npy", mmap_mode="r")


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each hash: ranges cut the hash space evenly, so ids that follow the ranges follow the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


class SortedArrays:
    """Keys sorted within ``ranges`` files (cut by ``range_of``), with value arrays beside them.

    ``present`` lists the ranges that have a file; the rest is empty.
    """

    def __init__(self, handle: str, table: str, ranges: int, present: list[int], values: dict[str, type]):
        self.ranges, self.kinds = ranges, values
        self.keys = {r: load(handle, f"{table}-{r}-keys") for r in present}
        self.values = {v: {r: load(handle, f"{table}-{r}-{v}") for r in present} for v in values}

    def _of(self, v: str, r: int, pos: np.ndarray) -> np.ndarray:
        return self.values[v][r][pos]

    def find(self, keys: np.ndarray, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """Values of sorted distinct keys (0 where a key is absent), and ``at``: range and position, or -1."""
        part = range_of(hashes, self.ranges)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(self.ranges + 1))
        out = {v: np.zeros(len(keys), kind) for v, kind in self.kinds.items()}
        out["range"], out["at"] = part, np.full(len(keys), -1, np.int64)
        for r, have in self.keys.items():
            rows = order[cuts[r]:cuts[r + 1]]
            if not len(rows) or not len(have):
                continue
            pos = np.searchsorted(have, keys[rows])
            pos[pos == len(have)] = 0
            hit = have[pos] == keys[rows]
            rows, pos = rows[hit], pos[hit]
            out["at"][rows] = pos
            for v in self.kinds:
                out[v][rows] = self._of(v, r, pos)
        return out


class SortedCounts(SortedArrays):
    """SortedArrays of whole numbers from 0 on: one byte each, and a sorted list of the places with ``LARGE`` or more."""

    LARGE = 255

    def __init__(self, handle: str, table: str, ranges: int, present: list[int], values: list[str]):
        super().__init__(handle, table, ranges, present, {v: np.int64 for v in values})
        self.places = {v: {r: load(handle, f"{table}-{r}-{v}-places") for r in present} for v in values}
        self.large = {v: {r: load(handle, f"{table}-{r}-{v}-large") for r in present} for v in values}

    def _of(self, v: str, r: int, pos: np.ndarray) -> np.ndarray:
        out = self.values[v][r][pos].astype(np.int64)
        beyond = np.flatnonzero(out == self.LARGE)
        if len(beyond):
            out[beyond] = self.large[v][r][np.searchsorted(self.places[v][r], pos[beyond])]
        return out


def save_table(folder: str, table: str, r: int, keys: np.ndarray, **values: np.ndarray) -> None:
    save(folder, f"{table}-{r}-keys", keys)
    for name, array in values.items():
        save(folder, f"{table}-{r}-{name}", array)


def save_counts(folder: str, table: str, r: int, keys: np.ndarray, **counts: np.ndarray) -> None:
    """What ``SortedCounts`` opens."""
    for name, array in list(counts.items()):
        places = np.flatnonzero(array >= SortedCounts.LARGE)
        counts[name] = np.minimum(array, SortedCounts.LARGE).astype(np.uint8)
        counts |= {f"{name}-places": places, f"{name}-large": array[places].astype(np.int64)}
    save_table(folder, table, r, keys, **counts)


def planes(keys: np.ndarray) -> bytes:
    """Sorted uint64 as differences, byte plane by byte plane: the zero planes vanish in Spark's compression."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view(np.uint64).ravel(), dtype=np.uint64)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, summed counts, index of a first occurrence)."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts), order[first]

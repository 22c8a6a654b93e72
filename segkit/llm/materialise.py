"""Training-order materialisation: fixed-stride binary shards in a keyed random order.

1. Texts become token ids (byte-level BPE ranks file, its path is a parameter; ids fit 16 bits), each followed by an end
   id, written once to the shared folder.  Each input partition counts its tokens; the partitions' running totals place
   every token in one global stream (an array in the shared folder, one number per input partition).
2. The stream is cut every ``length`` tokens.  Sequence i goes to slot F(i): a keyed Feistel permutation of the next even
   number of bits, walked along its cycle until it falls below the number of sequences, so slots are gapless.
3. Shard s holds slots s * per_shard onward.  Pieces of sequences travel to their shard, packed per task and shard, and each
   shard is one file: slot t is at byte (t mod per_shard) * length * 2.  The last sequence is filled up with the end id.

A reader opens a shard at any slot (``read``), and finds where sequence i stands by F; both need the parameters only.
Shards are bounded by ``per_shard`` and carry no key, so no document or source makes one larger.  A repeated task writes
the same bytes under the same name.

Null and empty texts are the end id alone; repeated rows are written as often as they occur; null doc_ids stay null in the
lists; extra columns are ignored; an empty table gives no sequences.
"""

from __future__ import annotations

import base64
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.llm import store
from segkit.llm.components import written
from segkit.llm.tokens import mix, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
# Fixed value: how the ranks' tokenizer splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANKS = frozenset((9, 10, 11, 12, 13, 32))
END_BYTES = np.uint16(END).tobytes()
CACHE = 200_000  # chunks in each of the two generations that a worker remembers
_ENCODERS: dict = {}


class Encoder:
    """Token ids of texts; blank runs with the word after them are encoded once and remembered.

    The pattern never joins a word with the ASCII blank after it, so a text may be cut there, and chunks that begin with a blank and
    end without one may be strung together: what a slice has new is encoded in one call.
    """

    def __init__(self, ranks: bytes):
        import tiktoken
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.width = np.zeros(max(merges.values()) + 1, np.int64)  # bytes of each id
        for token, i in merges.items():
            self.width[i] = len(token)
        self.young: dict[bytes, bytes] = {b"": END_BYTES}  # chunk: its ids, two bytes each
        self.old: dict[bytes, bytes] = {}
        self.blank = np.zeros(256, bool)
        self.blank[list(BLANKS)] = True

    def _encoded(self, data: bytes) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(data.decode("utf-8")), np.uint16)

    def _strung(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that begin with a blank and end without one."""
        ids = self._encoded(b"".join(chunks))
        ends = np.cumsum([len(c) for c in chunks])
        cuts = [0, *(2 * np.searchsorted(np.cumsum(self.width[ids]), ends, side="right")).tolist()]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        found = list(map(young.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        plain = []
        for i in new:
            c = chunks[i]
            ids = found[i] = old.get(c)
            if ids is None:
                if c[0] in BLANKS and c[-1] not in BLANKS:
                    plain.append(i)
                else:  # a text's first word, or blanks at its end
                    found[i] = self._encoded(c).tobytes()
        if plain:
            for i, ids in zip(plain, self._strung([chunks[i] for i in plain])):
                found[i] = ids
        if len(young) + len(new) > CACHE:
            self.old, self.young = young, {b"": END_BYTES}
        self.young.update((chunks[i], found[i]) for i in new)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids with an end id after each text, offsets)."""
        col = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(col)
        bounds = np.frombuffer(col.buffers()[1], np.int64, n + 1 + col.offset)[col.offset:]
        data = np.frombuffer(col.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        blank = self.blank[data]
        first = np.zeros(len(data) + 1, bool)
        first[1:len(data)] = blank[1:] & ~blank[:-1]
        first[bounds] = False
        # a chunk begins at every text (unless empty) and at every run of blanks, and an empty one, which stands for the end id, behind every text
        cut = np.sort(np.concatenate([np.flatnonzero(first), bounds[:-1][np.diff(bounds) > 0], bounds[1:]]), kind="stable")
        cut = np.append(cut, len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) // 2
        tokens = np.frombuffer(ids.buffers()[2], np.uint16, ends[-1])
        return tokens, np.concatenate([[0], ends[1:][np.diff(cut) == 0]])


class Feistel:
    """Keyed permutation of 0 .. n-1 and its inverse, on arrays."""

    def __init__(self, n: int, key: int, rounds: int = 6):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [mix(np.array([key * 1000 + r], np.uint64))[0] for r in range(rounds)]

    def _round(self, x: np.ndarray, keys, forward: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in keys:
            if forward:
                left, right = right, left ^ (mix(right + k) & self.mask)
            else:
                left, right = right ^ (mix(left + k) & self.mask), left
        return left << np.uint64(self.half) | right

    def _walk(self, x: np.ndarray, keys, forward: bool) -> np.ndarray:
        x = self._round(np.asarray(x).astype(np.uint64), keys, forward)
        out = np.flatnonzero(x >= self.n)
        while len(out):
            x[out] = self._round(x[out], keys, forward)
            out = out[x[out] >= self.n]
        return x.astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys, True)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1], False)


def token_table(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, part, first, n, tokens): each text's ids and its place in its input partition's stream, written once."""
    with open(vocabulary, "rb") as f:
        ranks = f.read()  # one bounded vocabulary file, shipped with the task

    def run(batches):
        from pyspark import TaskContext
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = Encoder(ranks)
        encoder, part, at = _ENCODERS[vocabulary], TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                tokens, offsets = encoder.encode(rows.column("text"))
                blobs = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer((offsets * 2).astype(np.int64).tobytes()), pa.py_buffer(tokens.tobytes())])
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array(np.full(rows.num_rows, part, np.int32)), pa.array((at + offsets[:-1]).astype(np.int64)),
                    pa.array(np.diff(offsets).astype(np.int64)), blobs.cast(pa.binary())], names=["doc_id", "part", "first", "n", "tokens"])
                at += int(offsets[-1])
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, part int, first long, n long, tokens binary")
    path = store.scratch_path(docs.sparkSession, "tokens")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def materialise(docs: DataFrame, folder: str | None = None, length: int = 1024, per_shard: int = 8192, key: int = 8,
                vocabulary: str = VOCABULARY) -> tuple[DataFrame, dict]:
    """Writes the shards into ``folder`` and returns one row per sequence, and the parameters to read them."""
    import zstandard

    spark = docs.sparkSession
    folder = folder or store.model_folder(spark, "shards")
    table = token_table(docs, vocabulary)
    totals = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row an input partition
    base = np.zeros(max(totals, default=0) + 2, np.int64)
    for part, n in totals.items():
        base[part + 1] = n
    base = np.cumsum(base)
    store.save(folder, "base", base)
    handle = store.publish(spark, folder)
    total = int(base[-1])
    sequences = -(-total // length)
    layout = {"folder": folder, "length": length, "per_shard": per_shard, "key": key, "sequences": sequences, "tokens": total}

    def cut(batches):
        begin, order, packer = store.load(handle, "base"), Feistel(sequences, key), zstandard.ZstdCompressor(level=5)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy()
            start = begin[batch.column("part").to_numpy()] + batch.column("first").to_numpy()
            first, last = start // length, (start + n - 1) // length
            row = np.repeat(np.arange(len(n)), last - first + 1)
            seq = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[row]
            lo, hi = np.maximum(start[row], seq * length), np.minimum((start + n)[row], (seq + 1) * length)
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint16)
            at = np.concatenate([[0], np.cumsum(n)])[row] + lo - start[row]
            slot = order(seq)
            shard = slot // per_shard
            ids = pc.fill_null(batch.column("doc_id").cast(pa.int64()), -2**63).to_numpy(zero_copy_only=False)[row]
            by = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(shard[by]) > 0, [True]])) if len(by) else np.zeros(1, np.int64)
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                rows = by[a:b]
                size = (hi - lo)[rows]
                ends = np.cumsum(size)
                body = tokens[np.arange(ends[-1]) + np.repeat(at[rows] - (ends - size), size)]
                head = np.stack([slot[rows], lo[rows] % length, size, ids[rows], seq[rows]]).astype(np.int64)
                out.append((int(shard[rows[0]]), len(rows), packer.compress(head.tobytes() + body.tobytes())))
            s, c, blob = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(c, pa.int32()), pa.array(blob, pa.binary())], names=["shard", "n", "blob"])

    def write(key_, group):
        shard = key_[0].as_py()
        unpack = zstandard.ZstdDecompressor()
        many = min(per_shard, sequences - shard * per_shard)
        out = np.full(many * length, END, np.uint16)
        heads = []
        for n, blob in zip(group.column("n").to_pylist(), group.column("blob").to_pylist()):
            raw = unpack.decompress(blob)
            head = np.frombuffer(raw, np.int64, 5 * n).reshape(5, n)
            body = np.frombuffer(raw, np.uint16, offset=40 * n)
            to = (head[0] - shard * per_shard) * length + head[1]
            ends = np.cumsum(head[2])
            out[np.arange(ends[-1]) + np.repeat(to - (ends - head[2]), head[2])] = body
            heads.append(head)
        save_shard(folder, shard, out)
        head = np.concatenate(heads, axis=1)
        head = head[:, np.lexsort((head[1], head[0]))]
        slots, first = np.unique(head[0], return_index=True)
        crc = [zlib.crc32(out[(s - shard * per_shard) * length:(s - shard * per_shard + 1) * length].tobytes()) for s in slots]
        ids = pa.array(head[3], mask=head[3] == -2**63)
        return pa.table({"slot": slots, "shard": pa.array(np.full(len(slots), shard, np.int32)),
                         "byte_offset": (slots - shard * per_shard) * length * 2, "sequence": head[4][first],
                         "n_tokens": np.add.reduceat(head[2], first), "tokens_crc32": pa.array(crc, pa.int64()),
                         "doc_ids": pa.ListArray.from_arrays(pa.array(np.append(first, head.shape[1]).astype(np.int32)), ids)})

    packed = table.mapInArrow(cut, "shard int, n int, blob binary")
    return packed.groupBy("shard").applyInArrow(write, "slot long, shard int, byte_offset long, sequence long, n_tokens long, tokens_crc32 long, doc_ids array<long>"), layout


def save_shard(folder: str, shard: int, tokens: np.ndarray) -> None:
    """Raw little-endian ids, written under a name of its own and then renamed."""
    if "://" in folder:
        from pyarrow import fs
        place, path = fs.FileSystem.from_uri(folder)
        with place.open_output_stream(f"{path}/shard-{shard:07d}.bin") as f:
            f.write(tokens.tobytes())
        return
    part = f"{folder}/.shard-{shard:07d}-{os.getpid()}"
    tokens.tofile(part)
    os.replace(part, f"{folder}/shard-{shard:07d}.bin")


def read(layout: dict, slot: int, count: int) -> np.ndarray:
    """``count`` sequences from ``slot`` on, each one row of ids; sequential within shards."""
    out, stop = [], min(slot + count, layout["sequences"])
    while slot < stop:
        shard, at = divmod(slot, layout["per_shard"])
        n = min(stop - slot, layout["per_shard"] - at)
        out.append(np.fromfile(f"{layout['folder']}/shard-{shard:07d}.bin", np.uint16, n * layout["length"], offset=at * layout["length"] * 2))
        slot += n
    return np.concatenate(out).reshape(-1, layout["length"]) if out else np.zeros((0, layout["length"]), np.uint16)


def digest(docs: DataFrame) -> DataFrame:
    """One row per sequence: its slot, place, documents and the crc of its bytes."""
    return materialise(docs)[0]

"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of byte spans. Every adjacent pair whose bytes have a rank waits, by its
position, in the bucket of that rank; a bitmap of three levels (64 ranks a word, 64 words a word) says
which buckets hold anything, so that the next rank to merge is three find-first-set steps away however
much text is queued. A merge leaves stale entries behind; they are recognised when they come up, as the
pair at that position then has another rank. Many pre-tokens share one queue (merges in one never touch
another), so that a bucket is found once for all of them; a bucket is left at once when a merge made a
pair of smaller rank.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct pre-tokens in each of a worker's two generations of known ids, and the longest of them in characters. Only speed depends on these.
CACHE_ITEMS = 180_000
CACHE_CHARS = 48
#: Pre-tokens that share a queue, and characters of texts taken at once: larger numbers only leave the CPU's caches.
QUEUED, TAKEN = 500, 1 << 16


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 rank"."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class RankQueue:
    """Buckets of positions by rank; next() is the smallest rank that has any, with its positions ascending."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.bucket: dict[int, list[int]] = {}

    def put(self, rank: int, positions: list[int]) -> None:
        b = self.bucket.get(rank)
        if b is not None:
            b += positions
            return
        self.bucket[rank] = positions
        i = rank >> 6
        self.low[i] |= 1 << (rank & 63)
        self.mid[i >> 6] |= 1 << (i & 63)
        self.top |= 1 << (i >> 6)

    def next(self) -> tuple[int, list[int]] | None:
        if not self.top:
            return None
        j = (self.top & -self.top).bit_length() - 1
        w = self.mid[j]
        i = j << 6 | (w & -w).bit_length() - 1
        w = self.low[i]
        rank = i << 6 | (w & -w).bit_length() - 1
        self.low[i] = w & (w - 1)
        if not self.low[i]:
            self.mid[j] &= self.mid[j] - 1
            if not self.mid[j]:
                self.top &= self.top - 1
        b = self.bucket.pop(rank)
        b.sort()
        return rank, b


class Tokenizer:
    """Encoding and decoding by a table of ranks; a rank is the id of its bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.cache: dict[str, bytes] = {}  # ids as packed 32-bit integers; what is used moves here from the older generation
        self.old: dict[str, bytes] = {}
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.double = np.full(1 << 16, -1, np.int64)
        for k, v in ranks.items():
            if len(k) == 2:
                self.double[k[0] << 8 | k[1]] = v

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each of some non-empty pre-tokens."""
        get = self.ranks.get
        out: list = [(r,) if (r := get(x)) is not None else None for x in pieces]
        work = [i for i, x in enumerate(out) if x is None]
        if not work:
            return out
        buf = b"".join([pieces[i] for i in work])
        n = len(buf)
        starts = np.cumsum([0] + [len(pieces[i]) for i in work])
        edge = bytearray(n + 1)  # a pre-token begins here
        data = np.frombuffer(buf, np.uint8).astype(np.int64)
        np.frombuffer(edge, np.uint8)[starts] = 1
        rank = np.full(n, -1, np.int64)
        rank[:-1] = self.double[data[:-1] << 8 | data[1:]]
        rank[starts[1:] - 1] = -1
        pair, token = rank.tolist(), self.single[data].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n))
        queue = self.queue
        order = np.argsort(rank, kind="stable")
        held = rank[order]
        order = order[np.searchsorted(held, 0) :]
        held = held[np.searchsorted(held, 0) :]
        cuts = np.flatnonzero(np.diff(held, prepend=-1, append=-1)).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            queue.put(int(held[a]), order[a:b].tolist())
        bucket, put = queue.bucket, queue.put
        while (e := queue.next()) is not None:
            r, at = e
            for done, i in enumerate(at):
                if pair[i] != r:
                    continue  # stale
                j = nxt[i]
                k = nxt[j]
                nxt[i], token[i], pair[j] = k, r, -1
                least = r
                if edge[k]:
                    pair[i] = -1
                else:
                    prv[k] = i
                    q = get(buf[i : nxt[k]])
                    if q is None:
                        pair[i] = -1
                    else:
                        pair[i] = q
                        if q in bucket:
                            bucket[q].append(i)
                        else:
                            put(q, [i])
                        if q < least:
                            least = q
                if not edge[i]:
                    p = prv[i]
                    q = get(buf[p:k])
                    if q is None:
                        pair[p] = -1
                    else:
                        pair[p] = q
                        if q in bucket:
                            bucket[q].append(p)
                        else:
                            put(q, [p])
                        if q < least:
                            least = q
                if least < r:
                    if done + 1 < len(at):
                        put(r, at[done + 1 :])
                    break
        ends = starts.tolist()
        for w, i, end in zip(work, ends, ends[1:], strict=False):
            ids = []
            while i < end:
                ids.append(token[i])
                i = nxt[i]
            out[w] = tuple(ids)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as 32-bit integers."""
        split = [self.split(x) for x in texts]
        used = set(chain.from_iterable(split))
        if len(self.cache) + len(used) > CACHE_ITEMS:
            self.old, self.cache = self.cache, {}
        cache, old = self.cache, self.old
        new = []
        for x in used.difference(cache):
            if (ids := old.get(x)) is not None:
                cache[x] = ids
            else:
                new.append(x)
        for at in range(0, len(new), QUEUED):
            part = new[at : at + QUEUED]
            cache.update(zip(part, [array("i", ids).tobytes() for ids in self.merge([x.encode() for x in part])], strict=True))
        out = [np.frombuffer(b"".join(map(cache.__getitem__, x)), np.int32) for x in split]
        for x in new:
            if len(x) > CACHE_CHARS:
                del cache[x]
        return out

    def encode_all(self, column: pa.Array, rows: int = 500):
        """Ids of each text of a column, a few texts at a time; a null is empty."""
        for a in range(0, len(column), rows):
            yield from self._some([x or "" for x in column.slice(a, rows).to_pylist()])

    def _some(self, texts: list[str], most: int = TAKEN):
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= most):
                size += len(texts[to])
                to += 1
            gc.disable()  # encoding makes no cycles, and each look for them walks the whole cache
            try:
                out = self.encode(texts[at:to])
            finally:
                gc.enable()
            yield from out
            at = to

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ready: dict[tuple[int, str], Tokenizer] = {}


def tokenizer(data: bytes, pattern: str) -> Tokenizer:
    """A worker's tokenizer for a rank file's content; built once a worker."""
    key = (hash(data), pattern)
    if key not in _ready:
        _ready[key] = Tokenizer(read_ranks(data), pattern)
    return _ready[key]


def _ranks(spark, path: str):
    """The rank file, read on the driver and broadcast. Its size is a tokenizer's (about 1 MB), not the corpus's."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path}: {len(data)} bytes are too many to broadcast")
    return spark.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of every whole text; a null text is the empty text and has no ids.

    Rows are independent: repeated ids give repeated rows, no row is dropped, other columns are ignored.
    Special tokens don't exist here: their strings in a text are ordinary text.
    """
    shared = _ranks(docs.sparkSession, path)

    def run(batches):
        t = tokenizer(shared.value, pattern)
        for b in batches:
            ids = list(t.encode_all(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, data binary): the bytes of ids. Null ids are no ids; an unknown id fails the query."""
    shared = _ranks(coded.sparkSession, path)

    def run(batches):
        t = tokenizer(shared.value, pattern)
        for b in batches:
            data = [t.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=[id_col, "data"])

    src = coded.select(F.col(id_col), F.col(ids_col).alias("ids"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each whole text, decode its ids, and return digests: (id_col, n_tokens, ids_sha256, decoded_sha256).

    ids_sha256 is of the decimal ids joined by commas; with_ids=True adds ids array<int>. One pass, without a
    shuffle: the ids of a few documents at a time are in memory. Nulls and repeats as in encode().
    """
    shared = _ranks(docs.sparkSession, path)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        t = tokenizer(shared.value, pattern)
        decimal = {i: str(i) for i in t.bytes_of}
        for b in batches:
            n, coded, decoded, held, size, first = [], [], [], [], 0, 0

            def flush(first, last):
                cols = [b.column(0)[first:last], pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]  # noqa: B023
                cols += [pa.array(held, pa.list_(pa.int32()))] * with_ids  # noqa: B023
                return pa.RecordBatch.from_arrays(cols, names=names)

            for row, ids in enumerate(t.encode_all(b.column(1))):
                n.append(len(ids))
                listed = ids.tolist()
                coded.append(hashlib.sha256(",".join(map(decimal.__getitem__, listed)).encode()).hexdigest())
                decoded.append(hashlib.sha256(t.decode(listed)).hexdigest())
                if with_ids:
                    held.append(ids)
                    size += len(ids)
                    if size > 1 << 18:
                        yield flush(first, row + 1)
                        n, coded, decoded, held, size, first = [], [], [], [], 0, row + 1
            yield flush(first, b.num_rows)

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)

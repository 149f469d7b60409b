"""Substring dedup by level-wise doubling.

A window of `size` words is repeated only if every shorter run of words in it is. So the search starts at a
quarter of the size: of the runs of that length in each window the one of the least hash is looked up
(equal windows agree on it, and neighbouring windows mostly share it, which leaves about an eighth of all
positions to shuffle). Windows whose run occurs once in the corpus are dropped; the survivors are
extended to half the size, tested the same way, and then to the full size, until no candidates survive.

These hashes only choose candidates. Neighbouring windows that share their least run of half the size form a stretch.
Stretches, and where several different ones share a run their windows, are told apart by 128-bit cryptographic
digests of their words; only what equals an earlier one so is removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm import textkit
from veriloom.llm.shared import bloom, cut, flagged, forget, join_spread

U = np.uint64
MAX = U(0xFFFFFFFFFFFFFFFF)


def least_in_window(h: np.ndarray, span: int) -> np.ndarray:
    """The least of each `span` consecutive values, from each place; places too near the end take what is there."""
    m, have = h, 1
    while have < min(span, len(m)):  # once it reaches the end from every place, nothing is left to take
        step = min(have, span - have)
        nxt = m.copy()
        np.minimum(m[: len(m) - step], m[step:], out=nxt[: len(m) - step])
        m, have = nxt, have + step
    return m


def least_runs(w: textkit.Words, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For the window of `size` words from each place: the least hash of its runs of `length` words; and whether it is in one document."""
    h, _ = textkit.grams(w, length)
    return least_in_window(h, size - length + 1), textkit.in_one(w, size)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _first_level(length: int, size: int):
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for w in textkit.words(b.column(1)):
                low, whole = least_runs(w, length, size)
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                d, v = w.doc[at], low[at]
                order = np.lexsort((v, d))
                d, v = d[order], v[order]
                new = np.ones(len(d), bool)
                new[1:] = (np.diff(d) != 0) | (v[1:] != v[:-1])
                d, v = d[new], v[new]
                many = _recurring(w, length, v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.view(np.int64)), pa.array(ids[w.row + d]), pa.array(np.where(_member(v, many), 2, 1).astype(np.int32))], names=["h", "id", "c"]
                )

    return run


def _recurring(w: textkit.Words, length: int, values: np.ndarray) -> np.ndarray:
    """Those of some hashes of runs, ascending, that begin at two places of one document: repeated already, even in one window."""
    h, whole = textkit.grams(w, length)
    at = np.flatnonzero(_member(h, np.unique(values)) & whole)
    d, v = w.doc[at], h[at]
    order = np.lexsort((v, d))
    d, v = d[order], v[order]
    return np.unique(v[1:][(d[1:] == d[:-1]) & (v[1:] == v[:-1])])


def _member(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ascending, x)
    at[at == len(ascending)] = 0
    return ascending[at] == x


def _spans(w: textkit.Words) -> tuple[bytes, np.ndarray]:
    """The words of a batch, each after one space, and where each begins (and the end)."""
    text = b" " + b" ".join(w.normal())
    begin = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
    if begin[-1] != len(text):  # documents without words have no place of their own
        text = b"".join(b" " + t for t in w.normal() if t)
    return text, begin


def _stretches(half: int, size: int):
    """Rows (h, id, at, n, d1, d2, c): n consecutive candidate windows from word `at` that share the least run of `half` words, of hash h;
    a digest of all their words; c: 2 if that run recurs in the document, else 1."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            lists = b.column(2)
            for w in textkit.words(b.column(1)):
                n = len(w.first) - 1
                known = np.unique(lists[w.row : w.row + n].flatten().to_numpy().view(U))
                low, whole = least_runs(w, size // 4, size)
                at = np.flatnonzero(whole & _member(low, known))
                if not len(at):
                    continue
                mid, _ = least_runs(w, half, size)
                doc = w.doc[at]
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(doc) != 0) | (mid[at[1:]] != mid[at[:-1]])
                start = np.flatnonzero(new)
                many = np.diff(np.append(start, len(at)))
                key, at, doc = mid[at[start]], at[start], doc[start]
                text, begin = _spans(w)
                d = textkit.digests(text[x:y] for x, y in zip(begin[at].tolist(), begin[at + many + size - 1].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(ids[w.row + doc]),
                        pa.array((at - w.first[doc]).astype(np.int32)),
                        pa.array(many.astype(np.int32)),
                        pa.array(d[:, 0]),
                        pa.array(d[:, 1]),
                        pa.array(np.where(_member(key, _recurring(w, half, key)), 2, 1).astype(np.int32)),
                    ],
                    names=["h", "id", "at", "n", "d1", "d2", "c"],
                )

    return run


def _windows(size: int):
    """Rows (id, at, d1, d2) of the windows of stretches: at, and a digest of the window's words."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for w in textkit.words(b.column(1)):
                n = len(w.first) - 1
                lists = b.column(2)[w.row : w.row + n]
                of = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                at, many = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "n"))
                doc = np.repeat(of, many)
                at = np.repeat(at - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                text, begin = _spans(w)
                place = w.first[doc] + at
                for lo in range(0, len(at), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    d = textkit.digests(text[x:y] for x, y in zip(begin[place[part]].tolist(), begin[place[part] + size].tolist(), strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[w.row + doc[part]]), pa.array(at[part].astype(np.int32)), pa.array(d[:, 0]), pa.array(d[:, 1])], names=["id", "at", "d1", "d2"])

    return run


def repeats(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, starts array<struct<at, n>>): stretches of n words' positions from `at` at which a window begins whose word sequence also starts earlier.

    Earlier: in a smaller id, or at a smaller position of the same document. Documents without such a window aren't returned.
    """
    if size < 4 or size % 4:
        raise ValueError("size is a multiple of 4")
    src = _source(docs, id_col, text_col)
    quarter, half = size // 4, size // 2
    runs = cut(src.mapInArrow(_first_level(quarter, size), "h long, id long, c int"), "level1")
    again = cut(runs.groupBy("h").agg(F.sum("c").alias("n"), F.count("*").alias("c")).where("n > 1").select("h", F.col("c").alias("rows")), "again1")
    kept = cut(join_spread(runs, again, ["h"], "rows").groupBy("id").agg(F.collect_list("h").alias("hs")), "kept1")  # a list is bounded by its document
    forget(runs, again)
    nothing = docs.sparkSession.createDataFrame([], "id long, starts array<struct<at:int,n:int>>")
    if kept.isEmpty():
        return nothing
    texts = flagged(src, F.col("id"), bloom(kept, "id"), "hit").where("hit").drop("hit")
    level2 = cut(texts.join(kept, "id").select("id", "text", "hs").mapInArrow(_stretches(half, size), "h long, id long, at int, n int, d1 long, d2 long, c int"), "level2")
    forget(kept)
    if level2.isEmpty():
        return nothing
    # Equal stretches: all but the first are later, and so are all their windows.
    equal = cut(level2.groupBy("h", "d1", "d2").agg(F.min(F.struct("id", "at")).alias("f"), F.count("*").alias("rows"), F.max("c").alias("c")), "equal")
    twice = equal.where("rows > 1").select("h", "d1", "d2", F.col("f.id").alias("fid"), F.col("f.at").alias("fat"), "rows")
    copies = join_spread(level2, cut(twice, "twice"), ["h", "d1", "d2"], "rows").where("id <> fid or at <> fat").select("id", "at", "n")
    # First stretches whose run others that differ have too, or that hold the run twice: their windows are looked at one by one.
    mixed = cut(equal.groupBy("h").agg(F.sum("c").alias("n"), F.count("*").alias("rows")).where("n > 1").select("h", "rows"), "mixed")
    open_ = join_spread(equal.select("h", "f"), mixed, ["h"], "rows").select(F.col("f.id").alias("id"), F.col("f.at").alias("at"))
    lengths = level2.select("id", "at", "n")
    wanted = cut(open_.join(lengths, ["id", "at"]).groupBy("id").agg(F.collect_list(F.struct("at", "n")).alias("parts")), "wanted")
    texts = flagged(src, F.col("id"), bloom(wanted, "id"), "hit").where("hit").drop("hit")
    windows = cut(texts.join(wanted, "id").select("id", "text", "parts").mapInArrow(_windows(size), "id long, at int, d1 long, d2 long"), "level3")
    forget(wanted)
    firsts = cut(windows.groupBy("d1", "d2").agg(F.min(F.struct("id", "at")).alias("f"), F.count("*").alias("rows")).where("rows > 1").select("d1", "d2", F.col("f.id").alias("fid"), F.col("f.at").alias("fat"), "rows"), "firsts")
    later = join_spread(windows, firsts, ["d1", "d2"], "rows").where("id <> fid or at <> fat").select("id", "at", F.lit(1).alias("n"))
    out = cut(copies.unionByName(later).groupBy("id").agg(F.collect_list(F.struct("at", "n")).alias("starts")), "repeats")
    forget(level2, equal, mixed, windows, firsts)
    return out


def _strip(size: int, digest: bool):
    def run(batches):
        for b in batches:
            for w in textkit.words(b.column(1)):
                n = len(w.first) - 1
                starts = b.column(2)[w.row : w.row + n]
                many = np.diff(w.first)
                gone = np.zeros(len(w.hash) + 1, np.int32)
                flat = starts.flatten()
                at, long = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "n"))
                of = np.repeat(np.arange(n), starts.value_lengths().fill_null(0).to_numpy())
                # Of rows that repeat an id one may be shorter than a place of another.
                x, y = (np.minimum(w.first[of] + at + k, w.first[of + 1]) for k in (0, long + size - 1))
                np.add.at(gone, x, 1)
                np.add.at(gone, y, -1)
                stay = np.cumsum(gone)[:-1] == 0
                text = w.data.tobytes()
                out = []
                for d in range(n):
                    span = np.flatnonzero(stay[w.first[d] : w.first[d + 1]]) + w.first[d]
                    kept = b" ".join([text[x:y] for x, y in zip(w.start[span].tolist(), w.end[span].tolist(), strict=True)])
                    out.append(hashlib.sha256(kept).hexdigest() if digest else kept)
                total = np.concatenate([[0], np.cumsum(stay)])
                removed = many - (total[w.first[1:]] - total[w.first[:-1]])
                result = pa.array(out, pa.string()) if digest else pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0)[w.row : w.row + n], pa.array(many), pa.array(removed), result], names=["id", "n_words", "n_removed", "kept"])

    return run


def dedup(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id_col, n_words, n_removed, kept): each text's words but those of windows that also start earlier, joined by one space.

    Words are runs of characters other than space and TAB to CR. Windows are judged on the input, not on what is
    left. A null text has no words. Rows with a null id are returned whole and are no window's earlier place; rows
    that repeat an id each lose the words at the id's positions, so ids should be unique. Texts of any length are taken whole. Other columns are
    ignored. digest=True returns SHA-256 of kept, in hex. Only texts with something to remove are shuffled.
    """
    found = repeats(docs, size, id_col, text_col)
    src = flagged(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), F.col("id"), bloom(found, "id"), "hit")
    none = F.lit(None).cast("array<struct<at:int,n:int>>")
    schema = "id long, n_words long, n_removed long, kept string"
    whole = src.where("not hit").select("id", "text", none.alias("starts")).mapInArrow(_strip(size, digest), schema)
    part = src.where("hit").join(found, "id", "left").select("id", "text", "starts").mapInArrow(_strip(size, digest), schema)
    return whole.unionByName(part).withColumnRenamed("id", id_col)

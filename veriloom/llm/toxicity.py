"""Toxicity scores from a factorization machine over hashed terms.

Terms of a text are its distinct lower-cased words and their first four and six bytes, hashed into
2**BITS slots; presence is 1. The machine's score is the logistic of
  w0 + sum w_i + 1/2 sum_f ((sum_i v_if)**2 - sum_i v_if**2),
so that each pair of terms has a learned weight <v_i, v_j>: an insult may count more beside the mention
of a group than either does alone. It is trained on a bounded sample of labelled rows; everything else
reads all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm import textkit
from veriloom.llm.shared import cut, forget

BITS = 18
#: Toxic rows that a term must have to be kept for its pairs.
PAIRED_LEAST = 8
U = np.uint64


@dataclass(frozen=True)
class Settings:
    """positives, negatives: the most labelled rows of either class that training reads (those of the smallest
    id hashes; class weights restore the labels' true shares). terms, least_z: slots kept by the z-score of their log odds between the classes, at most
    so many and of so much. paired: further slots, those of the most toxic rows, whatever their odds, as a term that says nothing alone
    may say much beside another. factors: length of a term's vector."""

    positives: int = 8_000
    negatives: int = 16_000
    terms: int = 16_384  # terms and paired together at most 32,767, as they are sent as short integers
    paired: int = 8_192
    least_z: float = 2.6
    factors: int = 8
    epochs: int = 12
    rate: float = 0.1
    decay: float = 2e-6
    seed: int = 11


@dataclass
class Machine:
    """slot: compact place of each hash slot, -1 if unused. Size fixed by BITS, terms and factors (2 MB)."""

    slot: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of n documents from (doc ascending, compact term) pairs."""
        z = np.full(n, self.w0)
        if len(term):
            z += np.bincount(doc, self.w[term], n)
            at = np.flatnonzero(np.diff(doc, prepend=-1))
            x = self.v[term]
            s = np.add.reduceat(x, at, axis=0)
            z[doc[at]] += 0.5 * ((s * s).sum(1) - np.add.reduceat((x * x).sum(1), at))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def terms(column: pa.Array):
    """(first row, rows, doc, slot) of consecutive parts of a text column, with repeats."""
    for w in textkit.words(column, lower=True, space=textkit.NO_LETTER):
        doc = w.doc.astype(np.int64)
        size = w.end - w.start
        docs, slots = [doc], [w.hash >> U(64 - BITS)]
        for k in (4, 6):
            long = size > k
            docs.append(doc[long])
            slots.append(w.begin(w.start[long], k) >> U(64 - BITS))
        yield w.row, len(w.first) - 1, np.concatenate(docs), np.concatenate(slots).astype(np.int64)


def distinct(doc: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc << 20 | slot)
    return key >> 20, key & ((1 << 20) - 1)


def choose(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, s: Settings) -> np.ndarray:
    """Compact places of slots, -1 for those left out, from the number of documents of either class that have each slot."""
    common = np.argsort(-pos, kind="stable")[: s.paired + s.terms]
    common = common[pos[common] >= PAIRED_LEAST]
    pos, neg = pos + 0.5, neg + 0.5
    odds = np.log(pos / (n_pos + 1)) - np.log(neg / (n_neg + 1))
    z = np.abs(odds) / np.sqrt(1 / pos + 1 / neg)
    best = np.sort(np.argpartition(-z, min(s.terms, len(z) - 1))[: s.terms])
    best = best[z[best] >= s.least_z]
    best = np.sort(np.append(best, common[~np.isin(common, best)][: s.paired]))
    slots = np.full(1 << BITS, -1, np.int32)
    slots[best] = np.arange(len(best))
    return slots


def train(doc: np.ndarray, term: np.ndarray, y: np.ndarray, weight: np.ndarray, slots: np.ndarray, s: Settings) -> Machine:
    """Adagrad on weighted logistic loss. doc ascending from 0; term: compact, distinct in a document. Both are held as they come, in six bytes a pair."""
    n = len(y)
    prior = float(np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    start = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.default_rng(s.seed)
    m = max(1, int(slots.max()) + 1)
    w, v = np.zeros(m), rng.normal(0, 0.01, (m, s.factors))
    w0, g0, gw, gv = np.log(prior / (1 - prior)), 1.0, np.full(m, 1.0), np.full((m, s.factors), 1.0)
    weight = weight / weight.mean()
    for _ in range(s.epochs):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            rows = np.sort(order[a : a + 256])
            size = start[rows + 1] - start[rows]
            at = np.repeat(start[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            t, r = term[at].astype(np.int64), np.repeat(np.arange(len(rows)), size)
            x = v[t]
            sums = np.stack([np.bincount(r, x[:, f], len(rows)) for f in range(s.factors)], 1)
            z = w0 + np.bincount(r, w[t], len(rows)) + 0.5 * ((sums * sums).sum(1) - np.bincount(r, (x * x).sum(1), len(rows)))
            e = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[rows]) * weight[rows]
            g = e.sum() / len(rows)
            g0 += g * g
            w0 -= s.rate * g / np.sqrt(g0)
            u, inv = np.unique(t, return_inverse=True)
            d = np.bincount(inv, e[r], len(u)) + s.decay * n * w[u]
            gw[u] += d * d
            w[u] -= s.rate * d / np.sqrt(gw[u])
            er = e[r][:, None] * (sums[r] - x)
            d = np.stack([np.bincount(inv, er[:, f], len(u)) for f in range(s.factors)], 1) + s.decay * n * v[u]
            gv[u] += d * d
            v[u] -= s.rate * d / np.sqrt(gv[u])
    return Machine(slots, float(w0), w, v)


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    """A machine from labels(id_col, label_col). Null ids and labels are ignored; an id labelled twice is toxic if one label says so.

    At most s.positives + s.negatives rows reach the driver, as lists of chosen terms, and 2**BITS counts.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    totals = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y, most in ((1, s.positives), (0, s.negatives)):
        part = one.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    sample = rows.join(F.broadcast(chosen), "id")  # at most positives + negatives rows of 12 bytes

    sample = cut(sample.select("id", "y", "text"), "labelled")

    def count(batches):
        held = np.zeros((2, 1 << BITS), np.int32)
        for b in batches:
            y = b.column("y").to_numpy()
            for row, n, doc, slot in terms(b.column("text")):
                doc, slot = distinct(doc, slot)
                toxic = y[row + doc] > 0
                held[1] += np.bincount(slot[toxic], minlength=1 << BITS).astype(np.int32)
                held[0] += np.bincount(slot[~toxic], minlength=1 << BITS).astype(np.int32)
        at = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[1][at]), pa.array(held[0][at])], names=["slot", "pos", "neg"])

    counts = sample.mapInArrow(count, "slot int, pos int, neg int").groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toPandas()
    by = np.zeros((2, 1 << BITS))
    for i, c in enumerate(("neg", "pos")):
        by[i][counts["slot"].to_numpy(int)] = counts[c].to_numpy(float)
    slots = choose(by[1], by[0], min(totals.get(1, 0), s.positives), min(totals.get(0, 0), s.negatives), s)
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def chosen_terms(batches):
        for b in batches:
            ids, y = b.column("id"), b.column("y")
            for row, n, doc, slot in terms(b.column("text")):
                term = shared.value[slot]
                doc, term = distinct(doc[term >= 0], term[term >= 0].astype(np.int64))
                off = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids[row : row + n], y[row : row + n], pa.ListArray.from_arrays(off, pa.array(term.astype(np.int16)))], names=["id", "y", "terms"])

    got = sample.mapInArrow(chosen_terms, "id long, y int, terms array<smallint>").toArrow().combine_chunks().sort_by([("id", "ascending")])
    forget(sample)
    y = got["y"].to_numpy().astype(float)
    if not len(y):
        return Machine(slots, -4.0, np.zeros(1), np.zeros((1, s.factors)))
    lists = got["terms"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    weight = np.ones(len(y))
    for k in (0, 1):
        if (y == k).any():
            weight[y == k] = totals[k] / (y == k).sum()
    return train(np.repeat(np.arange(len(size), dtype=np.int32), size), lists.flatten().to_numpy(), y, weight, slots, s)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score double) of every whole text, 0 to 1. Null and empty texts get the machine's prior.

    One pass without a shuffle; repeated rows are repeated, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = shared.value
        for b in batches:
            out = np.zeros(b.num_rows)
            for row, n, doc, slot in terms(b.column(1)):
                term = m.slot[slot]
                doc, term = distinct(doc[term >= 0], term[term >= 0].astype(np.int64))
                out[row : row + n] = m.score(doc, term, n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=[id_col, "score"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, machine: Machine, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all columns, whose score is below limit. Null and empty texts score the prior. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            out = np.zeros(b.num_rows)
            for row, n, doc, slot in terms(b.column(at)):
                term = m.slot[slot]
                doc, term = distinct(doc[term >= 0], term[term >= 0].astype(np.int64))
                out[row : row + n] = m.score(doc, term, n)
            yield b.filter(pa.array(out < limit))

    return docs.mapInArrow(run, docs.schema)

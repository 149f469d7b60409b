"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear score of its features, and a document of label 1 is preferred to one of label 0 with probability
logistic(difference of strengths): the weights are learned from preference pairs alone, by logistic loss on feature differences. Pairs have no
intercept, so that a threshold comes after: the quantile of the labelled strengths at the share of label 0. A score is logistic in the distance
from that quantile, which scores LIMIT.

Features: how a text is made (MEASURES: shares of kinds of bytes, repeated words, runs and lines, lengths), each cut at quantiles of the labelled
rows into BINS steps so that a weight can rise and fall along it, and the presence of hashed words, of unit length together.
Labels, languages, sources and ids are not among them. Training reads all labelled rows: they are dealt to parts of bounded size, each part's weights
are learned by themselves, and the weights are the parts' mean; quantile and slope come from the strengths of all of them. Scoring reads all rows, whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm import textkit
from veriloom.llm.shared import bloom, cut, flagged, forget

U = np.uint64
#: The score of a document whose strength is the quantile: those of LIMIT and more are kept.
LIMIT = 0.7
#: Hash slots of words, and steps of a measure.
WORD_BITS, BINS = 12, 8
#: Slopes that are tried, and what a unit of a weight is when weights are summed as whole numbers, in any order alike.
SLOPES, UNIT = np.geomspace(0.02, 20, 60), 1 << 40

MEASURES = (
    "log words", "log bytes", "capitals", "letters", "digits", "blanks", "line ends", "stops", "other marks",
    "bytes a word", "long words", "words with a mark", "distinct words", "commonest word", "word as the last", "distinct runs of three", "distinct lines", "words a line", "entropy of bytes",
)

_KIND = np.zeros(256, np.int8)  # 0 other marks
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(97, 123), *range(128, 256)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[32, 9]] = 4
_KIND[[10, 11, 12, 13]] = 5
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 6


@dataclass(frozen=True)
class Settings:
    """each: rows of either label in a part, about. A row of the larger class is in one part and `epochs` pairs, one an epoch, with a partner drawn
    from the other, whose rows are in as many parts as it takes to have so many, or all of them, in each."""

    each: int = 8_000
    epochs: int = 12
    batch: int = 256
    rate: float = 0.15
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Ranking:
    """edges[m]: the steps of measure m. A strength is the sum of a weight a measure's step and of the words' mean weight times its root."""

    edges: np.ndarray
    w: np.ndarray
    quantile: float
    slope: float
    flat: float | None = None  # the score of every text where the labels hold no pair

    def strength(self, dense: np.ndarray, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
        at, index, value = entries(dense, doc, slot, self.edges)
        return np.bincount(at, self.w[index] * value, len(dense))

    def score(self, strength: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(strength), self.flat)
        z = self.slope * (strength - self.quantile) + np.log(LIMIT / (1 - LIMIT))
        return np.where(strength >= self.quantile, np.maximum(LIMIT, 1 / (1 + np.exp(-np.clip(z, -35, 35)))), 1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _runs(key: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys a document, and how often its commonest occurs."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])))
    count, most = np.diff(np.append(first, len(k))), np.zeros(n)
    np.maximum.at(most, d[first], count)
    return np.bincount(d[first], minlength=n).astype(float), most


def measures(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, measures a document, doc, slot) of consecutive parts of a text column; (doc, slot) distinct and ascending."""
    for w in textkit.words(column, lower=True):
        n, off = len(w.first) - 1, w.offsets
        size = np.diff(off).astype(float)
        some = np.maximum(size, 1)
        of = np.repeat(np.arange(n), np.diff(off))
        kind = _KIND[w.data]
        kinds = np.bincount(of * 7 + kind, minlength=7 * n).reshape(n, 7)
        bytes_of = np.bincount(of * 256 + w.data, minlength=256 * n).reshape(n, 256) / some[:, None]
        doc = w.doc
        words = np.diff(w.first).astype(float)
        count = np.maximum(words, 1)
        length = w.end - w.start
        mark = np.append(0, np.cumsum((kind == 0) | (kind == 3)))
        runs, whole = textkit.grams(w, 3)
        distinct, most = _runs(w.hash, doc, n)
        triples, _ = _runs(runs[whole], doc[whole], n)
        same = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
        # lines that hold a word: hashed by the sum of mixed words, each tied to its place in the line
        ends = np.append(0, np.cumsum(kind == 5))[w.start] if len(w.start) else np.zeros(0, np.int64)
        head = np.flatnonzero(np.append(True, (np.diff(ends) != 0) | (np.diff(doc) != 0))) if len(doc) else np.zeros(0, np.int64)
        line, lines = np.zeros(0, U), np.zeros(n)
        if len(head):
            place = (np.arange(len(doc)) - np.repeat(head, np.diff(np.append(head, len(doc))))).astype(U)
            line = np.add.reduceat(textkit.mix(w.hash + place * U(textkit.FACTOR)), head)
            lines = np.bincount(doc[head], minlength=n).astype(float)
        distinct_lines, _ = _runs(line, doc[head], n)
        dense = np.stack([
            np.log1p(words), np.log1p(size), kinds[:, 1] / some, (kinds[:, 1] + kinds[:, 2]) / some, kinds[:, 3] / some, kinds[:, 4] / some, kinds[:, 5] / some,
            kinds[:, 6] / some, kinds[:, 0] / some, np.bincount(doc, length, n) / count, np.bincount(doc[length > 24], minlength=n) / count,
            np.bincount(doc[mark[w.end] > mark[w.start]], minlength=n) / count, distinct / count, most / count, np.bincount(doc[1:][same], minlength=n) / count,
            triples / np.maximum(words - 2, 1), distinct_lines / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1)),
            -(bytes_of * np.log(np.maximum(bytes_of, 1e-12))).sum(1),
        ], 1)
        key = np.unique(doc.astype(np.int64) << WORD_BITS | (w.hash >> U(64 - WORD_BITS)).astype(np.int64))
        yield w.row, dense, key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)


def entries(dense: np.ndarray, doc: np.ndarray, slot: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of hashed words and of the measures' steps."""
    n, m = dense.shape
    step = np.stack([np.searchsorted(edges[k], dense[:, k], "right") for k in range(m)], 1) if n else np.zeros((0, m), np.int64)
    index = (1 << WORD_BITS) + np.arange(m) * BINS + step
    held = np.maximum(np.bincount(doc, minlength=n), 1)
    return np.concatenate([doc, np.repeat(np.arange(n), m)]), np.concatenate([slot, index.ravel()]), np.concatenate([1 / np.sqrt(held[doc]), np.ones(n * m)])


def pairs_of(y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Each row of the larger class with one of the other, in random order: (preferred, other)."""
    up, low = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = max(len(up), len(low))
    deal = lambda rows: np.concatenate([rng.permutation(rows) for _ in range(-(-n // len(rows)))])[:n]  # noqa: E731  each row as often as any other
    return deal(up), deal(low)


def weights(index: np.ndarray, value: np.ndarray, start: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """Weights from pairs by Adagrad. start: where each document's features begin, and the end."""
    size = (1 << WORD_BITS) + len(MEASURES) * BINS
    rng = np.random.default_rng(s.seed)
    w, held = np.zeros(size), np.full(size, 1e-2)
    for _ in range(s.epochs):
        up, low = pairs_of(y, rng)
        for a in range(0, len(up), s.batch):
            rows = np.concatenate([up[a : a + s.batch], low[a : a + s.batch]])
            k = len(rows) // 2
            long = start[rows + 1] - start[rows]
            of = np.repeat(np.arange(len(rows)), long)
            pick = np.repeat(start[rows] - np.append(0, np.cumsum(long)[:-1]), long) + np.arange(long.sum())
            i, x = index[pick], value[pick]
            f = np.bincount(of, w[i] * x, len(rows))
            e = -1 / (1 + np.exp(np.clip(f[:k] - f[k:], -35, 35))) / k
            g = np.bincount(i, np.concatenate([e, -e])[of] * x, size) + s.decay * w
            held += g * g
            w -= s.rate * g / np.sqrt(held)
    return w


def by_document(dense: np.ndarray, doc: np.ndarray, slot: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, where each document's begin, and the end)."""
    at, index, value = entries(dense, doc, slot, edges)
    order = np.argsort(at, kind="stable")
    return index[order], value[order], np.searchsorted(at[order], np.arange(len(dense) + 1))


def losses(y: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Logistic loss of each of SLOPES, for labels and strengths above the quantile, a row each."""
    z = above[:, None] * SLOPES + np.log(LIMIT / (1 - LIMIT))
    return np.logaddexp(0, np.where(y == 1, -1, 1)[:, None] * z)


def train(dense: np.ndarray, doc: np.ndarray, slot: np.ndarray, y: np.ndarray, share: float, s: Settings) -> Ranking:
    """Of rows in memory: weights, then the quantile of strengths at `share` (of label 0), and the slope that fits the labels best."""
    edges = np.quantile(dense, np.arange(1, BINS) / BINS, axis=0).T if len(dense) else np.zeros((len(MEASURES), BINS - 1))
    if not (y == 1).any() or not (y == 0).any():
        return Ranking(edges, np.zeros((1 << WORD_BITS) + len(MEASURES) * BINS), 0.0, 1.0, flat=1 - share)
    index, value, start = by_document(dense, doc, slot, edges)
    w = weights(index, value, start, y, s)
    strength = np.add.reduceat(w[index] * value, start[:-1])
    weight = np.where(y == 1, (1 - share) / (y == 1).sum(), share / (y == 0).sum())
    order = np.argsort(strength, kind="stable")
    above = np.cumsum(weight[order]) > share * (1 + 1e-12)
    quantile = float(strength[order][min(int(np.argmax(above)), len(y) - 1)])
    loss = (weight[:, None] * losses(y, strength - quantile)).sum(0)
    return Ranking(edges, w, quantile, float(SLOPES[int(np.argmin(loss))]))


def _held(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures a document, doc, slot) of columns dense and slots."""
    dense, slots = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table.column("dense"), table.column("slots")))
    size = np.diff(slots.offsets.to_numpy())
    return dense.flatten().to_numpy(zero_copy_only=False).reshape(len(dense), -1), np.repeat(np.arange(len(slots)), size), slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def dealt(rows: DataFrame, n: dict[int, int], each: int) -> DataFrame:
    """rows with their part: every row of the larger class in one, those of the other in as many as give each part `each` of them, or all.

    n: rows of either label. A part has about `each` rows of either label.
    """
    few = 1 if n[1] < n[0] else 0
    parts = -(-n[1 - few] // each)
    copies = min(parts, -(-parts * min(n[few], each) // n[few]))
    own = F.when(F.col("y") == few, copies).otherwise(1)
    first = F.pmod(F.xxhash64("id"), F.lit(parts))
    return rows.withColumn("part", F.explode(F.sequence(first, first + own - 1))).withColumn("part", (F.col("part") % parts).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranking:
    """A ranking from labels(id_col, label_col), 1 preferred to 0. Null ids and labels are ignored; an id labelled twice is 0 if one label says so.

    All labelled rows are read. Of them measures and at most 2**WORD_BITS slots are shuffled, no texts; the driver gets sums, quantiles and a weight a feature.
    Quantiles count all rows and are off by a 100,000th of their ranks at most.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("y"))
    one = cut(one, "labelled")
    words = bloom(one, "id")
    rows = flagged(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), F.col("id"), words, "hit").where("hit").select("id", "text")

    def run(batches):
        for b in batches:
            for row, dense, doc, slot in measures(b.column("text")):
                n = len(dense)
                off = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(off, pa.array(slot.astype(np.int16)))
                made = pa.ListArray.from_arrays(np.arange(0, n * dense.shape[1] + 1, dense.shape[1], dtype=np.int32), pa.array(dense.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("id")[row : row + n], made, lists], names=["id", "dense", "slots"])

    made = cut(rows.mapInArrow(run, "id long, dense array<double>, slots array<smallint>").join(one, "id"), "preferred")
    totals = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = {0: 0, 1: 0} | {r["y"]: r["n"] for r in made.groupBy("y").agg(F.count("*").alias("n")).collect()}
    size = (1 << WORD_BITS) + len(MEASURES) * BINS
    if not n[0] or not n[1]:
        forget(one, words, made)
        return Ranking(np.zeros((len(MEASURES), BINS - 1)), np.zeros(size), 0.0, 1.0, flat=1 - (totals.get(0, 0) / sum(totals.values()) if totals else 0.5))
    steps = [k / BINS for k in range(1, BINS)]
    edges = np.array(made.agg(*[F.percentile_approx(F.col("dense")[k], steps, 100_000).alias(f"m{k}") for k in range(len(MEASURES))]).first(), float)

    def learn(table):
        table = table.sort_by([("id", "ascending")])
        y = table.column("y").to_numpy()
        w = np.zeros(size)
        if (y == 1).any() and (y == 0).any():
            w = weights(*by_document(*_held(table), edges), y, s)
        return pa.table({"feature": np.arange(size, dtype=np.int32), "units": np.round(w * UNIT).astype(np.int64), "learned": np.full(size, int(w.any()), np.int32)})

    means = dealt(made, n, s.each).groupBy("part").applyInArrow(learn, "feature int, units long, learned int").groupBy("feature").agg(F.sum("units").alias("units"), F.sum("learned").alias("learned")).toArrow().sort_by("feature")
    w = means["units"].to_numpy() / (np.maximum(means["learned"].to_numpy(), 1) * float(UNIT))
    ranking = Ranking(edges, w, 0.0, 1.0)
    shared = docs.sparkSession.sparkContext.broadcast(ranking)  # some 40 KB

    def strengths(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(shared.value.strength(*_held(b)))], names=["y", "strength"])

    told = cut(made.select("y", "dense", "slots").mapInArrow(strengths, "y int, strength double"), "strengths")
    quantile = told.agg(F.percentile_approx("strength", F.lit((n[0] + 0.5) / (n[0] + n[1])), 100_000)).first()[0]

    def lost(batches):
        for b in batches:
            loss = losses(b.column("y").to_numpy(), b.column("strength").to_numpy() - quantile).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(SLOPES), dtype=np.int32)), pa.array(np.round(loss * (1 << 20)).astype(np.int64))], names=["slope", "loss"])

    best = told.mapInArrow(lost, "slope int, loss long").groupBy("slope").agg(F.sum("loss").alias("loss")).orderBy("loss", "slope").first()
    forget(one, words, made, told)
    return Ranking(edges, w, float(quantile), float(SLOPES[best["slope"]]))


def score(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, strength double, score double, keep boolean) of every whole text: keep where its strength reaches the quantile, that is its score LIMIT.

    Null texts are empty, and empty ones are scored as texts without words; repeated rows are repeated, ties score alike, other columns are ignored,
    an empty table gives none. Where the labels hold no pair every text scores the share of label 1 (0.5 without labels). One pass without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranking)  # some 40 KB

    def run(batches):
        r = shared.value
        for b in batches:
            out = np.zeros(b.num_rows)
            for row, dense, doc, slot in measures(b.column(1)):
                out[row : row + len(dense)] = r.strength(dense, doc, slot)
            made = r.score(out)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), pa.array(made), pa.array(made >= LIMIT)], names=[id_col, "strength", "score", "keep"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, strength double, score double, keep boolean")

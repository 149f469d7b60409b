"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

Sketch: a document's shingles are thrown into t bins in rounds. In round i < t a fresh hash gives each
shingle a bin and a value, and bins that are still empty keep the least value thrown into them; in round
t + i all shingles go to bin i. So every coordinate fills, after O(t log t + set) throws, and two sets
agree in a coordinate with a probability of their Jaccard similarity, more concentrated than with
independent minima.

Links: documents of equal word sequences (by a 128-bit cryptographic digest) are one node. Coordinates are
banded into buckets; each node of a bucket meets the bucket's smallest node, which connects most of it without a
pair of others; then only a bucket's stragglers, nodes of another component than its first node's, meet those of its nodes
whose sizes allow a link. All these meet in blocks of bounded size that hold whole texts: a link is confirmed on the full sets of
shingles, word by word, and no hash stands for a word there. What isn't compared is in one component already, so
no link between components is lost.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm import textkit
from veriloom.llm.shared import bloom, components, cut, flagged, forget, join_spread

U = np.uint64
MAX = U(0xFFFFFFFFFFFFFFFF)
#: Nodes of a side of a block, and shingles of a side, both on average and at most.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19


@dataclass(frozen=True)
class Plan:
    """words a shingle; least similarity in percent; rows a band; most chance that a pair at the threshold meets in no band."""

    words: int = 5
    percent: int = 80
    rows: int = 4
    miss: float = 1e-7

    @property
    def bands(self) -> int:
        return ceil(log(self.miss) / log(1 - (self.percent / 100) ** self.rows))

    @property
    def size(self) -> int:
        return self.bands * self.rows


def shingle_sets(w: textkit.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of k words of each document, ascending, and the documents' offsets.

    A document of fewer words is one shingle of all of them; one without words has none.
    """
    h, whole = textkit.grams(w, k)
    size = np.diff(w.first)
    parts: list[np.ndarray] = []
    short = {m: textkit.grams(w, m)[0] for m in set(size[(size > 0) & (size < k)].tolist())}
    counts = np.zeros(len(size), np.int64)
    for d, (a, n) in enumerate(zip(w.first[:-1].tolist(), size.tolist(), strict=True)):
        if n >= k:
            s = np.unique(h[a : a + n - k + 1])
        elif n:
            s = short[n][a : a + 1]
        else:
            continue
        counts[d] = len(s)
        parts.append(s)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate([[0], np.cumsum(counts)])


def sketch(values: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Coordinates [document, t] of sets given one after another; a document without shingles keeps MAX."""
    n = len(offsets) - 1
    out = np.full(n * t, MAX, U)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    seeds = textkit.mix(np.arange(1, 2 * t + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    open_ = np.diff(offsets) > 0
    for i in range(2 * t):
        x = textkit.mix(values ^ seeds[i])
        cell = doc * t + (((x >> U(32)) * U(t)) >> U(32)).astype(np.int64) if i < t else doc * t + (i - t)
        free = out[cell] == MAX
        np.minimum.at(out, cell[free], x[free])
        if i % 4 == 3 or i < 4 or i >= t:
            open_ = (out.reshape(n, t) == MAX).any(1) & open_
            keep = open_[doc]
            doc, values = doc[keep], values[keep]
            if not len(doc):
                break
    return out.reshape(n, t)


def sketches(docs: DataFrame, p: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, d1, d2, bands array<long>): set size, a 128-bit digest of the words in order, band keys."""
    b, r, t = p.bands, p.rows, p.size
    seeds = textkit.mix(np.arange(7, 7 + b, dtype=U) * U(0xA24BAED4963EE407))
    names = ["id", "n", "d1", "d2", "bands"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for w in textkit.words(batch.column(1), lower=True):
                s, off = shingle_sets(w, p.words)
                n = len(off) - 1
                c = sketch(s, off, t)
                key = np.broadcast_to(seeds, (n, b)).copy()
                for i in range(r):
                    key = textkit.mix(key * U(3) + c.reshape(n, b, r)[:, :, i])
                d = textkit.digests(w.normal())
                has = np.diff(off) > 0
                sizes = np.where(has, b, 0)
                bands = textkit.long_list(key[has].ravel(), np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[w.row : w.row + n],
                        pa.array(np.diff(off).astype(np.int64)),
                        pa.array(d[:, 0]),
                        pa.array(d[:, 1]),
                        bands,
                    ],
                    names=names,
                )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>")


def _block_links(percent: int, k: int):
    """Links between sides 0 and 1 of each (key, cls, i, j) block of a partition sorted by them; rows have id, label and text.

    Sets are those of whole texts' words, compared as words. A block's intersections are one product of two 0/1 matrices over the
    shingles that both sides have; of its links only those that join labels not joined yet in the block are returned. A
    block's rows may span batches.
    """

    def links(side, ids, label, texts, out) -> None:
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(a) or not len(b):
            return
        exact = textkit.Exact()
        sets = exact.runs(exact.words([t.lower() for t in texts]), k)
        n = np.array([len(x) for x in sets])
        values = np.concatenate(sets)
        row = np.repeat(np.arange(len(ids)), n)
        order = np.argsort(values, kind="stable")
        values, row = values[order], row[order]
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        col = np.cumsum(new) - 1
        on = side[row]
        both = (np.bincount(col, on == 0) > 0) & (np.bincount(col, on == 1) > 0)
        place = np.cumsum(both) - 1
        keep = both[col]
        col, row = place[col[keep]], row[keep]
        at = np.zeros(len(ids), np.int64)
        at[a], at[b] = np.arange(len(a)), np.arange(len(b))
        same = np.zeros((len(a), len(b)), np.int64)
        width = 1 << 13
        for lo in range(0, int(both.sum()), width):
            x, y = np.searchsorted(col, [lo, lo + width])
            m = [np.zeros((len(t), width), np.float32) for t in (a, b)]
            r, c = row[x:y], col[x:y] - lo
            for s in (0, 1):
                mine = side[r] == s
                m[s][at[r[mine]], c[mine]] = 1
            same += (m[0] @ m[1].T).astype(np.int64)
        # An empty text, which another row of an id may have, is linked with nothing.
        ok = (same > 0) & (100 * same >= percent * (n[a][:, None] + n[b][None, :] - same)) & (label[a][:, None] != label[b][None, :])
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        for i, j in zip(*(z.tolist() for z in np.nonzero(ok)), strict=True):
            p, q = root(int(label[a[i]])), root(int(label[b[j]]))
            if p != q:
                top[max(p, q)] = min(p, q)
                out[0].append(int(ids[a[i]]))
                out[1].append(int(ids[b[j]]))

    def run(batches):
        held, size = [], 0  # batches of a block that isn't whole yet
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("key", "cls", "i", "j")]
            new = np.flatnonzero(np.any([np.diff(c) != 0 for c in keys], 0)) + 1
            if held and any(c[0] != h.column(n)[h.num_rows - 1].as_py() for c, n, h in zip(keys, ("key", "cls", "i", "j"), [held[-1]] * 4, strict=True)):
                new = np.concatenate([[0], new])
            if not len(new):
                held.append(batch)
                continue
            t = pa.Table.from_batches([*held, batch.slice(0, int(new[-1]))])
            before = sum(h.num_rows for h in held)
            yield blocks(t, np.concatenate([[0], before + new]))
            held = [batch.slice(int(new[-1]))]
        if held:
            t = pa.Table.from_batches(held)
            yield blocks(t, np.array([0, t.num_rows]))

    def blocks(t: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        side, ids, label = (t.column(c).to_numpy() for c in ("side", "id", "label"))
        texts = t.column("text")
        out: tuple[list, list] = ([], [])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:
                links(side[a:b], ids[a:b], label[a:b], [x.as_buffer().to_pybytes() for x in texts[a:b]], out)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["u", "v"])

    return run


def _met(dealt: DataFrame, docs: DataFrame, p: Plan, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) found inside the blocks of dealt(key, cls, i, j, side, id, label), written to the shared folder.

    A text is taken once for each block that its row is dealt to. Of rows that repeat an id each text counts.
    """
    dealt = cut(dealt, "dealt")
    known = bloom(dealt.select("id"), "id")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")).where("id is not null")
    texts = flagged(src, F.col("id"), known, "hit").where("hit").select("id", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = dealt.join(texts, "id").select("key", "cls", "i", "j", "side", "id", "label", "text").repartition(n, "key", "cls", "i", "j").sortWithinPartitions("key", "cls", "i", "j")
    found = cut(blocks.mapInArrow(_block_links(p.percent, p.words), "u long, v long").distinct(), "links")
    forget(dealt, known)
    return found


def _deal(n: str, seed: int):
    """A block below column n for each id."""
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")


def _upto(n: str):
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _blocks_of(count, shingles):
    """How many blocks hold so many nodes of so many shingles."""
    return F.ceil(F.greatest(F.lit(1), count / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")


def star_links(rows: DataFrame, docs: DataFrame, p: Plan, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) of buckets' first nodes with their others. rows: (key, id, n), a table; one bucket or more a node."""
    first = rows.groupBy("key").agg(F.min(F.struct("id", "n")).alias("f"), F.max("id").alias("m"), F.count("*").alias("c")).where("f.id <> m")
    first = cut(first.select("key", F.col("f.id").alias("u"), F.col("f.n").alias("un"), "c"), "first")
    close = f"100 * least(un, n) >= {p.percent} * greatest(un, n)"
    if first.isEmpty():
        return first.select("u", F.col("key").alias("v"))
    star = cut(join_spread(rows, first, ["key"], "c").where("id <> u").where(close).select("u", "id", "n").distinct(), "star")
    parts = cut(star.groupBy("u").agg(_blocks_of(F.count("*"), F.sum("n")).alias("nb"), F.count("*").alias("c")), "parts")
    zero = lambda c: F.lit(0).alias(c)
    lead = parts.select(F.col("u").alias("key"), zero("cls"), zero("i"), _upto("nb").alias("j"), zero("side"), F.col("u").alias("id"), F.col("u").alias("label"))
    rest = join_spread(star, parts, ["u"], "c").select(F.col("u").alias("key"), zero("cls"), zero("i"), _deal("nb", 2).alias("j"), F.lit(1).alias("side"), "id", F.col("id").alias("label"))
    found = _met(lead.unionByName(rest), docs, p, id_col, text_col)
    forget(first, star, parts)
    return found


def rest_links(rows: DataFrame, docs: DataFrame, p: Plan, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) that join buckets' stragglers: nodes of another label than their bucket's first node. rows: (key, id, n, label), a table.

    A bucket's nodes are classed by the logarithm of their sizes, so that sizes that allow a link lie in one class or in
    neighbouring ones; a straggler meets the nodes of its own class and of its neighbours, in blocks of about BLOCK by BLOCK nodes.
    """
    lead = rows.groupBy("key").agg(F.min(F.struct("id", "label")).alias("f"), F.min("label").alias("l"), F.max("label").alias("m"), F.count("*").alias("c")).where("l <> m")
    lead = cut(lead.select("key", F.col("f.label").alias("first"), "c"), "lead")
    width = log(100 / p.percent) * (1 + 1e-9) if p.percent < 100 else 1e-9  # wider than the widest gap of two sizes that link
    cls = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    if lead.isEmpty():
        return lead.selectExpr("key as u", "first as v")
    some = cut(join_spread(rows, lead, ["key"], "c").select("key", "id", "n", "label", (F.col("label") != F.col("first")).alias("odd"), cls.alias("cls")), "mixed")
    near = some.where("odd").withColumn("cls", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)))
    both = some.withColumn("side", F.lit(1)).unionByName(near.withColumn("side", F.lit(0)))
    odd = F.col("side") == 0
    size = lambda on: _blocks_of(F.count_if(on), F.sum(F.when(on, F.col("n"))))
    parts = both.groupBy("key", "cls").agg(F.count("*").alias("c"), F.count_if(odd).alias("odds"), size(odd).alias("na"), size(~odd).alias("nb")).where("odds > 0 and odds < c").drop("odds")
    parts = cut(parts, "parts")
    known = join_spread(both, parts, ["key", "cls"], "c")
    # A straggler lies in one block row and meets all block columns, a node the other way round.
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    known = known.withColumn("i", F.explode(F.when(odd, F.array(_deal("na", 1))).otherwise(upto("na"))))
    known = known.withColumn("j", F.explode(F.when(odd, upto("nb")).otherwise(F.array(_deal("nb", 2)))))
    found = _met(known.select("key", "cls", "i", "j", "side", "id", "label"), docs, p, id_col, text_col)
    forget(lead, some, parts)
    return found


def groups(docs: DataFrame, p: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every row of docs.

    component_id: the smallest id reachable over links, itself included; kept: the row has that id.
    A-Z are lower-cased; words are runs of characters other than space and TAB to CR; a text of fewer words than a shingle's is
    one shingle; an empty or null text has none and no link. Rows with a null id have no link and are kept.
    Rows that repeat an id count as one document in links. Other columns are ignored.
    """
    s = cut(sketches(docs, p, id_col, text_col), "sketches")
    usable = s.where("n > 0 and id is not null")
    equal = cut(usable.groupBy("d1", "d2").agg(F.min("id").alias("node"), F.count("*").alias("c")).where("c > 1"), "equal")
    node = F.coalesce("node", "id")
    tagged = cut(join_spread(usable, equal, ["d1", "d2"], "c", "left").select("id", node.alias("node"), "n", F.when(F.col("id") == node, F.col("bands")).alias("bands")), "tagged")
    none = s.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    rows = cut(tagged.where("id = node").select("id", "n", F.explode("bands").alias("key")), "rows")
    links = star_links(rows, docs, p, id_col, text_col)
    found = cut(components(links), "components")
    labelled = cut(rows.join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("label")), "labelled")
    forget(rows)
    again = rest_links(labelled, docs, p, id_col, text_col)
    if not again.isEmpty():
        edges = found.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v").unionByName(again)
        found = cut(components(edges), "components")
        forget(again)
    forget(labelled)
    copies = equal.groupBy("node").agg(F.sum("c").alias("c"))
    found = cut(found.join(copies, "node", "left").select("node", "component", F.coalesce("c", F.lit(1)).alias("c")), "found")
    out = join_spread(tagged.select("id", "node", "n"), found, ["node"], "c", "left").select("id", "n", F.coalesce("component", "node").alias("component"))
    return out.unionByName(none).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )

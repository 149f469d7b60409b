"""Exact top-k inner-product search: Fagin's threshold algorithm over streams of blocks.

Candidates are hashed into streams and queries into groups; every group meets every stream in one task,
which holds the group's queries and one block of candidates at a time, so that memory is bounded
however many there are. A block has, for each dimension, the list of its vectors sorted by that component. The group's
queries walk all lists at once, step by step, from the ends that their components' signs prefer; a vector is scored for all queries
that still walk when it is first met in any list. A query stops as soon as its bound (the sum over dimensions of query component times the
next value of the list, the most that an unseen vector can score) is below its k-th best score. That score is carried from block to block, and
from a first stream to all others, so that later walks end sooner or don't begin. No vector is scored twice for a query, so that a walk which
meets the whole block costs what a scan does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.llm.shared import cut

#: Candidates a block; queries a group; candidates a stream, unless there would be fewer tasks than shuffle partitions.
CANDIDATES, QUERIES, STREAM = 8192, 4096, 1 << 17
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_NONE = np.iinfo(np.int64).max


class Lists:
    """A block's vectors with the sorted list of every dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T.astype(np.int32))
        self.value = np.take_along_axis(x.T, self.order, axis=1)

    def bound(self, q: np.ndarray, depth: int) -> np.ndarray:
        """The most that a vector not among the first `depth` of any list can score, for each query."""
        top, low = self.value[:, len(self.ids) - 1 - depth], self.value[:, depth]
        return np.maximum(q, 0) @ top + np.minimum(q, 0) @ low

    def search(self, own: int, q: np.ndarray, k: int, step: int = 16, ids: np.ndarray | None = None, scores: np.ndarray | None = None, floor=None) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, depth reached) of the k best of all vectors but the query's own; ties to smaller ids.

        ids and scores: the best of earlier blocks; floor: a score that k others are known to reach.
        """
        n = len(self.ids)
        dims = np.flatnonzero(q)
        up = q[dims] > 0
        seen = np.zeros(n, bool)
        ids = np.zeros(0, np.int64) if ids is None else ids
        scores = np.zeros(0, self.x.dtype) if scores is None else scores
        done, depth, left = 0, 0, n
        if not len(dims):  # every score is 0, which no bound beats
            depth, new = n, np.arange(n)
        while left:
            if depth < n:
                depth = min(n, depth + step)
                step *= 2
                down, rise = self.order[dims[up], n - depth : n - done], self.order[dims[~up], done:depth]
                fresh = np.zeros(n, bool)
                fresh[down.ravel()] = True
                fresh[rise.ravel()] = True
                fresh &= ~seen
                new = np.flatnonzero(fresh)
            seen[new] = True
            left -= len(new)
            s = self.x[new] @ q
            mine = self.ids[new]
            least = _least(scores, k, floor)
            if least is not None:
                keep = s >= least
                s, mine = s[keep], mine[keep]
            other = mine != own
            scores, ids = np.concatenate([scores, s[other]]), np.concatenate([ids, mine[other]])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            done = depth
            least = _least(scores, k, floor)
            if depth < n and least is not None:
                ends = np.where(up, self.value[dims, n - depth], self.value[dims, depth - 1])
                if (ends * q[dims]).sum() < least:
                    break
        return ids, scores, depth


def _least(scores: np.ndarray, k: int, floor):
    """The score below which nothing counts: of the k-th best so far or the known floor, the greater; None without either."""
    mine = scores[-1] if len(scores) == k else None
    return mine if floor is None or (mine is not None and mine > floor) else floor


class Group:
    """A group of queries and the best of what they have met."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, floor: list, k: int):
        self.ids, self.q, self.floor, self.k = ids, q, floor, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, q.dtype)) for _ in ids]
        self.depths: list[int] = []  # how deep each walk went, and how many walks their bound ended
        self.stopped = 0

    def least(self, rows: np.ndarray | None = None) -> np.ndarray:
        rows = range(len(self.ids)) if rows is None else rows.tolist()
        out = [_least(self.best[r][1], self.k, self.floor[r]) for r in rows]
        return np.array([-np.inf if x is None else x for x in out], float)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Take in a block of candidates, ids ascending and distinct."""
        if not len(ids) or not len(self.ids):
            return
        width = max(x.shape[1], self.q.shape[1])
        x, self.q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, self.q))
        if self.q.dtype == object or np.abs(x).max(initial=0) * np.abs(self.q).max(initial=0) * max(width, 1) >= 2.0**53:
            exact = lambda m: np.array([[int(y) for y in r] for r in m], object).reshape(m.shape)  # noqa: E731  exact, if slow
            x, self.q = exact(x), exact(self.q)
            self.best = [(i, s.astype(object)) for i, s in self.best]
            lists = Lists(ids, x)
            for r in range(len(self.ids)):
                self._walk(lists, r)
            return
        lists = Lists(ids, x)
        self._walk_all(lists, np.flatnonzero(lists.bound(self.q, 0) >= self.least()))

    def _walk(self, lists: Lists, r: int) -> None:
        ids, scores, depth = lists.search(self.ids[r], self.q[r], self.k, 16, *self.best[r], self.floor[r])
        self.best[r] = ids, scores
        self._ended(np.array([depth]), depth < len(lists.ids))

    def _walk_all(self, lists: Lists, rows: np.ndarray, step: int = 16) -> None:
        """The walks of some queries, in step: each ends where its bound falls below its k-th best score, or with the block."""
        n = len(lists.ids)
        seen, done = np.zeros(n, bool), 0
        while len(rows):
            depth = min(n, done + step)
            step *= 2
            q = self.q[rows]
            still = (q == 0).all(1).any()  # a query of zeros has no list of its own and scores all alike
            down, rise = (q > 0).any(0) | still, (q < 0).any(0) | still
            fresh = np.zeros(n, bool)
            fresh[lists.order[down, n - depth : n - done].ravel()] = True
            fresh[lists.order[rise, done:depth].ravel()] = True
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            some = max(1, (1 << 22) // max(1, len(new)))
            for lo in range(0, len(rows) if len(new) else 0, some):
                self._score(lists, rows[lo : lo + some], new)
            done = depth
            if done == n or seen.all():
                self._ended(np.full(len(rows), done), False)
                return
            ends = lists.bound(q, done) < self.least(rows)
            self._ended(np.full(int(ends.sum()), done), True)
            rows = rows[~ends]

    def _ended(self, depths: np.ndarray, by_bound: bool) -> None:
        self.depths += depths.tolist()
        self.stopped += len(depths) if by_bound else 0

    def _score(self, lists: Lists, rows: np.ndarray, new: np.ndarray) -> None:
        """Score vectors that were met for the first time, and keep the best."""
        s = self.q[rows] @ lists.x[new].T
        n, ids_new, least = s.shape[1], lists.ids[new], self.least(rows)
        at = np.searchsorted(ids_new, self.ids[rows])
        at[at == n] = 0
        own = ids_new[at] == self.ids[rows]
        s[np.flatnonzero(own), at[own]] = -np.inf
        if n > self.k:
            least = np.maximum(least, np.partition(s, n - self.k, axis=1)[:, n - self.k])
        hit = (s >= least[:, None]) & (s > -np.inf)
        for i in np.flatnonzero(hit.any(1)).tolist():
            r = rows[i]
            some = np.flatnonzero(hit[i])
            ids, scores = self.best[r]
            mine = s[i, some]
            if len(some) > self.k:  # ids ascend, so that a stable sort leaves ties to smaller ones
                top = np.argsort(-mine, kind="stable")[: self.k]
                some, mine = some[top], mine[top]
            ids, scores = np.concatenate([ids, ids_new[some]]), np.concatenate([scores, mine])
            best = np.lexsort((ids, -scores))[: self.k]
            self.best[r] = ids[best], scores[best]

    def result(self) -> pa.RecordBatch:
        sizes = [len(i) for i, _ in self.best]
        long = lambda s: np.array([min(max(int(y), _LEAST), _MOST) for y in s], np.int64) if s.dtype == object else s.astype(np.int64)
        cat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        cols = [np.repeat(self.ids, sizes), cat([i for i, _ in self.best]), cat([long(s) for _, s in self.best])]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["query_id", "vec_id", "score"])


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    size = lists.value_lengths().to_numpy()
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out


def _streams(k: int, block: int):
    """The best of every query of each (qb, sb) group of a partition that is sorted by them, queries first."""

    def run(batches):
        key, group, queries, held, size = None, None, [], [], 0

        def ready() -> Group:
            t = pa.Table.from_batches(queries).combine_chunks().sort_by("vec_id")
            return Group(t["vec_id"].to_numpy(), _matrix(t["v"].combine_chunks()), t["floor"].to_pylist(), k)

        def meet(group: Group) -> None:
            t = pa.Table.from_batches(held).combine_chunks().sort_by("vec_id")
            for lo in range(0, t.num_rows, block):
                part = t.slice(lo, block)
                group.meet(part["vec_id"].to_numpy(), _matrix(part["v"].combine_chunks()))

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("qb", "sb", "side")]
            cuts = np.flatnonzero(np.any([np.diff(c, prepend=-1) != 0 for c in cols], 0)).tolist() + [batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here, side = (int(cols[0][a]), int(cols[1][a])), int(cols[2][a])
                if here != key:
                    if queries:
                        group = group or ready()
                        if held:
                            meet(group)
                        yield group.result()
                    key, group, queries, held, size = here, None, [], [], 0
                if side == 0:
                    queries.append(batch.slice(a, b - a))
                elif queries:
                    group = group or ready()
                    held.append(batch.slice(a, b - a))
                    size += b - a
                    if size >= block:
                        meet(group)
                        held, size = [], 0
        if queries:
            group = group or ready()
            if held:
                meet(group)
            yield group.result()

    return run


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, v array<double>) of whole numbers floor(scale * x), x as double; unusable vectors and null ids are left out."""
    v = F.col(vec_col)
    usable = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < float("inf"), F.lit(False)))
    # floor() of a double is a long in Spark, which a large component overflows: beyond 2**52 a double is whole already.
    whole = lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
    scaled = F.transform(v, lambda x: whole(x.cast("double") * scale))
    return vectors.where(usable & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding", candidates_block: int = CANDIDATES, queries_block: int = QUERIES, stream: int = STREAM) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's k candidates of the largest inner product of floor(scale * x).

    Every row of vectors is a candidate but the query's own id; ties go to the smaller vec_id; a query
    with fewer than k candidates returns all. Vectors that are null or hold null or non-finite components (also once scaled)
    and rows without an id take no part; of rows that repeat an id the smallest vector counts; shorter
    vectors are padded with zeros; scores beyond a long are cut to its range. Other columns are ignored.
    A candidate is shuffled once for each group of queries_block queries, a query once for each stream.
    """
    spark = vectors.sparkSession
    c, q = (cut(quantized(df, id_col, vec_col, scale).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors") for df in (vectors, queries))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    up = lambda n, most: max(1, -(-n // most))
    n = c.count()
    groups = up(q.count(), queries_block)
    streams = max(up(n, stream), min(up(n, candidates_block), up(tasks, groups)))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = c.withColumn("sb", block(streams, 1)).withColumn("side", F.lit(1)).withColumn("floor", F.lit(None).cast("double"))
    q = q.withColumn("qb", block(groups, 2)).withColumn("side", F.lit(0))
    cols = ["qb", "sb", "side", "vec_id", "v", "floor"]

    def met(q: DataFrame, first: bool) -> DataFrame:
        some = F.lit(0).alias("sb") if first else every(streams).alias("sb")
        rows = q.select("qb", some, "side", "vec_id", "v", "floor").where(("sb = 0" if first else "sb > 0") if streams > 1 else "true")
        mine = c.where(("sb = 0" if first else "sb > 0") if streams > 1 else "true").withColumn("qb", every(groups)).select(*cols)
        dealt = rows.unionByName(mine).repartition(tasks, "qb", "sb").sortWithinPartitions("qb", "sb", "side")
        return dealt.mapInArrow(_streams(k, candidates_block), "query_id long, vec_id long, score long")

    best = met(q.withColumn("floor", F.lit(None).cast("double")), True)
    if streams > 1:
        best = cut(best, "first")
        # A score that k candidates of the first stream reach; as a double it may round up only beyond 2**53, where it is left out.
        floor = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("least")).where(f"n >= {k} and abs(least) < {1 << 52}")
        best = best.unionByName(met(q.join(floor.select("vec_id", F.col("least").cast("double").alias("floor")), "vec_id", "left"), False))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

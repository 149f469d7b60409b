"""Benchmark decontamination by greedy string tiling.

The benchmark's runs of `least` words are the seeds. One pass over the documents joins each text's
running Karp-Rabin hashes with them; for each item that a text may share enough seeds with, tiles are laid:
the longest common run of words that lie in no earlier tile is marked, again and again, down to
`least` words. Tiles may lie in any order, so that a passage whose sentences were moved is covered as
well as a verbatim one; a text is contaminated by an item whose words the tiles cover to a threshold.

Seeds that many items share cost little: to cover a share of an item a text must hold so many of its seeds that one of them is among the
rarest of the item, so that only those lead from a text to the item (an item's commonest seeds, such as a prompt's first words, do not). Of the items
found, those go on whose seeds in the text cover enough together. Only then are places paired. A text and an item that
repeat themselves have pairs without bound: they are listed by some diagonals at a time, PAIRS at once, and beyond so many runs are
laid from the longest on in bands of BAND, so that memory is bounded whatever repeats.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm import textkit

U = np.uint64
#: Seeds that one pass broadcasts at most (24 bytes each); a larger benchmark is taken in so many passes.
PASS_SEEDS = 1_000_000
#: Pairs of places of one text and item that are listed at once, runs that are, and entries that lead to items.
PAIRS, BAND, ENTRIES = 1 << 20, 1 << 18, 1 << 21


@dataclass
class Seeds:
    """Seeds of some items: item i has words first[i]:first[i + 1], and seeds hash[of[i]:of[i + 1]] in order of place. key_hash (ascending) and key_item lead
    from a hash to the items that it is a key of: those whose rarest seeds, as many as a covering text can't do without, hold it.

    short has the items of fewer than `least` words: number of words, hash (ascending) and item of each. texts has the items' words,
    as hashes only choose candidates.
    """

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    hash: np.ndarray
    of: np.ndarray
    key_hash: np.ndarray
    key_item: np.ndarray
    filter: np.ndarray
    least: int
    short: list[tuple[int, np.ndarray, np.ndarray]]
    texts: list[bytes]


def _filter(h: np.ndarray) -> np.ndarray:
    f = np.zeros(1 << 20, bool)
    f[(h >> U(44)).astype(np.int64)] = True
    return f


def needed(words: np.ndarray, floor: float, least: int) -> np.ndarray:
    """How many seeds of an item, at least, a text holds whose tiles cover `floor` of its words: a tile of n words has n - least + 1 of them, which are n / least at least."""
    return np.maximum(1, np.ceil(np.ceil(np.round(floor * words, 9)) / least)).astype(np.int64)


def seeds(ids: list[int], texts: list[str | None], least: int, floor: float = 0.0) -> Seeds:
    """Items with fewer words than `least` are one seed of all their words, found by their own length."""
    hashes, items, words, first, short, plain = [], [], [], [0], [], []
    for w in textkit.words(pa.array(texts, pa.string()), lower=True, most=1 << 60):
        h, whole = textkit.grams(w, least)
        at = np.flatnonzero(whole)
        d = w.doc[at]
        hashes.append(h[at])
        items.append(d)
        words.append(w.hash)
        first = w.first
        plain = list(w.normal())
        for n in range(1, least):
            d = np.flatnonzero(np.diff(w.first) == n)
            if len(d):
                h = textkit.grams(w, n)[0][w.first[d]]
                order = np.argsort(h, kind="stable")
                short.append((n, h[order], d[order]))
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    h, i = cat(hashes, U), cat(items, np.int64)
    of = np.searchsorted(i, np.arange(len(ids) + 1))
    distinct, number, count = np.unique(h, return_inverse=True, return_counts=True)
    # An item's seeds from the rarest on: it may lack all but needed() of them, so that one of the others before those is held.
    order = np.lexsort((h, count[number], i))
    rank = np.arange(len(h)) - of[i[order]]
    keys = order[rank <= (np.diff(of) - needed(np.diff(np.asarray(first)), floor, least))[i[order]]] if len(h) else order
    keys = keys[np.argsort(h[keys], kind="stable")]
    return Seeds(np.array(ids, np.int64), cat(words, U), np.asarray(first), h, of, h[keys], i[keys], _filter(distinct), least, short, plain)


def common_runs(a_pos: np.ndarray, b_pos: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal common runs (places in a, places in b, words) from all pairs of places of equal seeds of `least` words, or all of some diagonals."""
    diagonal = b_pos - a_pos
    order = np.lexsort((a_pos, diagonal))
    a, d = a_pos[order], diagonal[order]
    new = np.ones(len(a), bool)
    new[1:] = (np.diff(d) != 0) | (np.diff(a) != 1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(a)))
    return a[start], a[start] + d[start], size + least - 1


def true_runs(runs: list[tuple[int, int, int]], a: list[bytes], b: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """The parts of runs, of `least` words or more, whose words are equal, which equal hashes don't prove."""
    out = []
    for i, j, n in runs:
        if a[i : i + n] == b[j : j + n]:
            out.append((i, j, n))
            continue
        same = np.array([x == y for x, y in zip(a[i : i + n], b[j : j + n], strict=True)])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        out += [(i + int(s), j + int(s), int(e - s)) for s, e in zip(edges[::2], edges[1::2], strict=True) if e - s >= least]
    return out


def _words_of(w: textkit.Words, d: int) -> list[bytes]:
    return w.folded[w.offsets[d] : w.offsets[d + 1]].tobytes().split()


class Places:
    """Where a text's seeds are: distinct hashes, ascending, and the places of each, ascending."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.place = places[order]
        self.hash, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash among the distinct ones, -1 for those that aren't there."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)


def items_of(p: Places, s: Seeds) -> np.ndarray:
    """The items that a text's seeds lead to, ascending."""
    low, high = np.searchsorted(s.key_hash, p.hash, "left"), np.searchsorted(s.key_hash, p.hash, "right")
    n = high - low
    low, n = low[n > 0], n[n > 0]
    found = np.zeros(0, np.int64)
    total = np.cumsum(n)
    x = 0
    while x < len(n):  # some entries at a time
        y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + ENTRIES, "right")))
        m = n[x:y]
        at = np.repeat(low[x:y] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        found = np.union1d(found, s.key_item[at])
        x = y
    return found


def covering(items: np.ndarray, p: Places, s: Seeds, floor: float) -> np.ndarray:
    """Those of the items whose seeds in the text, all together, cover at least `floor` of their words."""
    out = []
    for x in range(0, len(items), 4096):
        some = items[x : x + 4096]
        m = s.of[some + 1] - s.of[some]
        at = np.repeat(s.of[some] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        of = np.repeat(np.arange(len(some)), m)
        there = p.find(s.hash[at]) >= 0
        at, of = at[there], of[there]
        step = np.full(len(at), s.least)  # words that a seed adds to those before it
        same = of[1:] == of[:-1]
        step[1:][same] = np.minimum(s.least, np.diff(at)[same])
        covered = np.bincount(of, step, len(some))
        size = (s.first[some + 1] - s.first[some]).astype(float)
        out.append(some[(covered > 0) & (covered >= floor * size)])
    return np.concatenate(out) if out else items


def runs_between(number: np.ndarray, p: Places, least: int):
    """All maximal common runs, as arrays (places in the item, places in the text, words), some diagonals at a time, in order of diagonals.

    number: the text's number of each seed of the item, -1 if it isn't there. A run lies on one diagonal; diagonals of more than PAIRS pairs together
    are parted, so that no more are listed at once (one diagonal has no more pairs than the item has seeds).
    """
    a = np.flatnonzero(number >= 0)
    k = number[a]
    end = int(p.place.max(initial=-1)) + 1
    seed = np.repeat(np.arange(len(p.hash)), p.count)
    order = np.lexsort((p.place, seed))
    place = p.place[order]
    key = seed[order] * (end + 1) + place  # ascending: a seed's places are found by two searches
    todo = [(-len(number), end)]
    while todo:
        low, high = todo.pop()
        x = np.searchsorted(key, k * (end + 1) + np.clip(a + low, 0, end), "left")
        n = np.searchsorted(key, k * (end + 1) + np.clip(a + high, 0, end), "left") - x
        total = int(n.sum())
        if total > PAIRS and high - low > 1:
            parts = min(high - low, -(-total // PAIRS) + 1)
            cuts = [low + (high - low) * j // parts for j in range(parts + 1)]
            todo += [(c, d) for c, d in zip(cuts[:-1], cuts[1:], strict=True)][::-1]
        elif total:
            b = place[np.repeat(x - (np.cumsum(n) - n), n) + np.arange(total)]
            yield common_runs(np.repeat(a, n), b, least)


class Tiling:
    """Tiles of one item and one text, laid from runs that come in order of length, then place."""

    def __init__(self, item: list[bytes], text: list[bytes], least: int):
        self.item, self.text, self.least = item, text, least
        self.in_a, self.in_b = np.zeros(len(item), bool), np.zeros(len(text), bool)
        self.out: list[tuple[int, int, int]] = []
        self.heap: list[tuple[int, int, int]] = []

    def lay(self, runs: list[tuple[int, int, int]], before: tuple[int, int]) -> None:
        """Lay these runs and what is left of earlier ones, but for those from `before` (minus words, place in the item) on, which wait."""
        for i, j, n in true_runs(runs, self.item, self.text, self.least):
            self.heap.append((-n, i, j))
        heapify(self.heap)
        while self.heap and self.heap[0][:2] < before:
            n, i, j = heappop(self.heap)
            n = -n
            used = self.in_a[i : i + n] | self.in_b[j : j + n]
            if not used.any():
                self.in_a[i : i + n] = True
                self.in_b[j : j + n] = True
                self.out.append((i, j, n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]]).astype(np.int8)))
            for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if e - s >= self.least:
                    heappush(self.heap, (s - e, i + s, j + s))

    def room(self) -> bool:
        """Whether both sides have `least` words together that lie in no tile."""
        for used in (self.in_a, self.in_b):
            edges = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]]).astype(np.int8)))
            if not (edges[1::2] - edges[::2] >= self.least).any():
                return False
        return True


def tile(item: list[bytes], text: list[bytes], number: np.ndarray, p: Places, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the text, words), the longest first, then by place in the item and the text."""
    t = Tiling(item, text, least)
    listed = lambda keep: [r for a, b, n in runs_between(number, p, least) for k in [keep(a, n)] for r in zip(a[k].tolist(), b[k].tolist(), n[k].tolist(), strict=True)]
    everything = (0, 0)
    if int(p.count[number[number >= 0]].sum()) <= PAIRS:
        t.lay(listed(lambda a, n: np.ones(len(a), bool)), everything)
        return t.out
    # Bands from the longest runs on, of so many that BAND bounds them; a length of more runs than that is cut by places in the item.
    count = np.zeros(len(item) + 1, np.int64)
    for a, b, n in runs_between(number, p, least):
        count += np.bincount(n, minlength=len(count))
        if len(whole := np.flatnonzero(n == len(item))) and item == text[b[whole].min() : b[whole].min() + len(item)]:
            return [(0, int(b[whole].min()), len(item))]  # diagonals ascend, and a run of all the item's words leaves none to others
    lengths = np.flatnonzero(count)[::-1].tolist()
    x = 0
    while x < len(lengths) and t.room():
        y, total = x + 1, int(count[lengths[x]])
        while y < len(lengths) and total + count[lengths[y]] <= BAND:
            total += int(count[lengths[y]])
            y += 1
        high, low = lengths[x], lengths[y - 1]
        cuts = min(-(-total // BAND), len(item)) if y == x + 1 else 1
        edges = [len(item) * k // cuts for k in range(cuts)] + [len(item) + 1]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if t.room():
                t.lay(listed(lambda i, n, a=a, b=b: (n <= high) & (n >= low) & (i >= a) & (i < b)), (1 - low, -1) if b > len(item) else (-low, b))
        x = y
    t.lay([], everything)
    return t.out


def _short_hits(w: textkit.Words, s: Seeds):
    """(document, item, words) of every document that holds a short item, by its words."""
    for n, hashes, items in s.short:
        h, whole = textkit.grams(w, n)
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        at = np.flatnonzero(whole & (hi > lo))
        of, text = -1, b""
        for d, x, y in sorted(set(zip(w.doc[at].tolist(), lo[at].tolist(), hi[at].tolist(), strict=True))):
            if d != of:
                of, text = d, b" " + b" ".join(_words_of(w, d)) + b" "
            yield from ((d, int(i), n) for i in items[x:y] if b" " + s.texts[i] + b" " in text)


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", floor: float = 0.0, short: bool = False) -> DataFrame:
    """(id_col, item_id, tiles, tiled_words, item_words, coverage) of each text and item that share a seed, coverage at least floor.

    Words are runs of characters other than space and TAB to CR, A-Z lower-cased. Null or empty texts and
    items overlap with nothing, nor do items of fewer than `least` words, unless short=True: then a text that
    holds one whole overlaps with it in one tile. A row with a null id is left out of
    docs' output and benchmark; repeated rows of docs give repeated rows. Other columns are ignored.
    The documents are not shuffled. The benchmark is read in parts of PASS_SEEDS seeds, each broadcast
    for one pass, so that its size isn't assumed.
    """
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    passes = max(1, -(-total // PASS_SEEDS))  # an item has no more seeds than words
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).distinct().collect()
        one = _one_pass(src, seeds([r[0] for r in part], [r[1] for r in part], least, floor), id_col, floor, short)
        out = one if out is None else out.unionByName(one)
    return out


def _one_pass(src: DataFrame, s: Seeds, id_col: str, floor: float, short: bool) -> DataFrame:
    shared = src.sparkSession.sparkContext.broadcast(s)
    names = [id_col, "item_id", "tiles", "tiled_words", "item_words", "coverage"]
    kinds = [pa.int64()] * 5 + [pa.float64()]

    def run(batches):
        s = shared.value
        size = np.diff(s.first)
        for b in batches:
            ids = b.column(0).to_numpy()
            rows: list[tuple] = []
            for w in textkit.words(b.column(1), lower=True):
                if short:
                    rows += [(int(ids[w.row + d]), int(s.ids[i]), 1, n, n, 1.0) for d, i, n in _short_hits(w, s)]
                h, whole = textkit.grams(w, s.least)
                at = np.flatnonzero(s.filter[(h >> U(44)).astype(np.int64)] & whole)
                of = np.searchsorted(w.first, at, "right") - 1
                cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    d = int(of[x])
                    p = Places(h[at[x:y]], at[x:y] - w.first[d])
                    items = covering(items_of(p, s), p, s, floor)
                    text = _words_of(w, d) if len(items) else []
                    for i in items.tolist():
                        got = tile(s.texts[i].split(), text, p.find(s.hash[s.of[i] : s.of[i + 1]]), p, s.least)
                        covered = sum(t[2] for t in got)
                        if got and covered >= floor * size[i]:
                            rows.append((int(ids[w.row + d]), int(s.ids[i]), len(got), covered, int(size[i]), covered / int(size[i])))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return src.mapInArrow(run, f"`{id_col}` long, item_id long, tiles long, tiled_words long, item_words long, coverage double")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.6, least: int = 5, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The overlaps whose tiles cover at least `coverage` of an item's words, and the texts that hold an item of fewer than `least` words whole."""
    return overlaps(docs, benchmark, least, id_col, text_col, floor=coverage, short=True, **more)

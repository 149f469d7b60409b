"""Phrase collocation mining: dictionary codes, fixed-width keys, a range-partitioned radix sort and run-length counts.

1. Words are counted by language. Those that occur `least` times get numbers from 1 and make the dictionary: a phrase that occurs so often has no
   other words, so that pieces of text break at all of them.
2. Each place of a piece makes one key, the numbers of the (up to LONGEST) words from there on, zero where the piece ends, in fields of a
   fixed width. Sorted, the occurrences of every phrase of every length are one run of keys that begin alike.
3. Tasks sort and run-length count their keys (a least-significant-digit radix sort by 16-bit digits), cut them at the bounds of ranges, and
   ship blocks of keys. Ranges come from quantiles of a sample, which chooses bounds only. A range's blocks meet in one task, are sorted
   again, and their runs are summed at each length; runs at a range's ends may go on in the next, so that sums by phrase close the count. Where
   there are more than FAN ranges, blocks are dealt in two steps, by groups of ranges and then by ranges, as each block must stay worth a row.
4. Frequent phrases are few against the text: cuts, scores and containment are joins of them by key.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.llm import textkit
from veriloom.llm.shared import cut, forget, join_spread

LONGEST = 5
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_APART = _BLANK | _BREAK


@dataclass(frozen=True)
class Sizes:
    """How work is cut; no result depends on it. held: words, and bytes of words, of a dictionary that is broadcast; a larger one is joined with
    the words of each batch of texts. keys: a task sorts at once. range: keys a range is meant to hold. fan: ranges that a block is cut into at once.
    sampled: keys that choose bounds, about."""

    held: int = 2_000_000
    held_bytes: int = 32 << 20
    keys: int = 1 << 20
    range: int = 1 << 20
    fan: int = 1024
    sampled: int = 1 << 18


class Tokens:
    """The words of part of a text column: `distinct` words and each occurrence's index there, document and piece."""

    def __init__(self, w: textkit.Words):
        size = w.end - w.start
        held = np.zeros(len(w.data) + 1, np.int32)
        np.add.at(held, w.start, 1)
        np.add.at(held, w.end, -1)
        text = w.folded[: len(w.data)][np.cumsum(held[:-1]) > 0]
        offsets = np.append(0, np.cumsum(size)).astype(np.int64)
        all_words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(text.tobytes())])
        coded = all_words.dictionary_encode()
        self.distinct, self.index = coded.dictionary, coded.indices.to_numpy()
        self.doc = w.doc
        before = np.append(0, np.cumsum(_BREAK[w.data]))[w.start] if len(size) else np.zeros(0, np.int64)
        fresh = np.ones(len(size), bool)
        fresh[1:] = (np.diff(before) != 0) | (np.diff(self.doc) != 0)
        self.fresh = fresh  # a piece begins here

    def counts(self) -> np.ndarray:
        return np.bincount(self.index, minlength=len(self.distinct))


def tokens(column: pa.Array):
    """Tokens of consecutive parts of a text column, ASCII capitals lowered; nulls are empty."""
    for w in textkit.words(column, lower=True, space=_APART):
        yield Tokens(w)


def by_language(batch: pa.RecordBatch):
    """(language, texts) of a batch's columns lang and text."""
    coded = batch.column("lang").dictionary_encode()
    at = coded.indices.to_numpy()
    for i, lang in enumerate(coded.dictionary.to_pylist()):
        rows = np.flatnonzero(at == i)
        yield lang, batch.column("text") if len(rows) == batch.num_rows else batch.column("text").take(pa.array(rows))


_WORDS = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word binary, n) of texts(lang, text), and a row with a null word that counts all of a language's words."""

    def run(batches):
        for b in batches:
            for lang, column in by_language(b):
                held, all_of = [], 0
                for t in tokens(column):
                    held.append(pa.table({"word": t.distinct.cast(pa.binary()), "n": t.counts().astype(np.int64)}))
                    all_of += len(t.index)
                if not held:
                    continue
                t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
                word = pa.concat_arrays([t["word"].combine_chunks().cast(pa.binary()), pa.nulls(1, pa.binary())])
                n = pa.concat_arrays([t["n_sum"].combine_chunks(), pa.array([all_of], pa.int64())])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(word), pa.string()), word, n], schema=_WORDS)

    return texts.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """(lang, word, n, id): words numbered densely from 1. No task sees more than one partition of them."""
    parts = cut(words.withColumn("part", F.spark_partition_id()), "frequent")
    sizes = parts.groupBy("part").agg(F.count("*").alias("rows")).orderBy("part").collect()  # a row a shuffle partition
    start, rows = 0, []
    for r in sizes:
        rows.append((r["part"], start))
        start += r["rows"]
    if start >= 1 << 32:
        raise ValueError("more frequent words than numbers of 32 bits")
    starts = F.broadcast(parts.sparkSession.createDataFrame(rows, "part int, start long"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))
    out = cut(parts.join(starts, "part").withColumn("id", F.col("start") + place).select("lang", "word", "n", "id"), "dictionary")
    forget(parts)
    return out


class Dictionary:
    """Numbers of words, found by a binary search of their hashes and proved by their bytes."""

    def __init__(self, words: pa.Array, ids: np.ndarray):
        words = words.cast(pa.large_binary())
        h = _hash(words)
        order = np.argsort(h, kind="stable")
        self.hash, self.ids, self.words = h[order], ids[order], words.take(pa.array(order))
        same = np.flatnonzero(self.hash[1:] == self.hash[:-1])
        self.others = {self.words[i].as_py(): int(self.ids[i]) for i in np.unique(np.concatenate([same, same + 1])).tolist()}  # words of equal hash

    def find(self, words: pa.Array) -> np.ndarray:
        """The number of each word, 0 for those that aren't there."""
        if not len(self.ids) or not len(words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hash, _hash(words)), len(self.ids) - 1)
        same = pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False)
        out = np.where(same, self.ids[at], 0)
        if self.others:
            for i, w in enumerate(words.to_pylist()):
                out[i] = self.others.get(w, out[i])
        return out


def _hash(words: pa.Array) -> np.ndarray:
    out = [w.hash for w in textkit.words(words, space=np.zeros(256, bool))]
    h = np.concatenate(out) if out else np.zeros(0, np.uint64)
    assert len(h) == len(words)
    return h


def keys_of(t: Tokens, ids: np.ndarray) -> np.ndarray:
    """The keys of a part's places, as rows of LONGEST numbers: those with at least two words."""
    word = ids[t.index]
    n = len(word)
    if not n:
        return np.zeros((0, LONGEST), np.int64)
    known = word > 0
    edge = t.fresh | ~known
    edge[1:] |= ~known[:-1]
    run = np.cumsum(edge)
    out = np.zeros((n, LONGEST), np.int64)
    out[:, 0] = word
    for j in range(1, LONGEST):
        if n > j:
            out[: n - j, j] = np.where(run[j:] == run[:-j], word[j:], 0)
    return out[out[:, 1] > 0]


def digits(keys: np.ndarray, wide: bool) -> np.ndarray:
    """Keys as rows of 16-bit digits, the most significant first: one a number, or two where numbers need it."""
    if not wide:
        return keys.astype(np.uint16)
    out = np.empty((len(keys), 2 * LONGEST), np.uint16)
    out[:, ::2], out[:, 1::2] = keys >> 16, keys & 0xFFFF
    return out


def radix(d: np.ndarray) -> np.ndarray:
    """The order of rows of digits: one stable counting pass a digit, from the last (numpy sorts 16-bit numbers stably by radix)."""
    order = None
    for k in range(d.shape[1] - 1, -1, -1):
        column = d[:, k]
        if not len(column) or (column == column[0]).all():
            continue
        if order is None:
            order = np.argsort(column, kind="stable")
        else:
            order = order[np.argsort(column[order], kind="stable")]
    return np.arange(len(d)) if order is None else order


def run_lengths(d: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, ascending, with their counts summed."""
    if not len(d):
        return d, n
    order = radix(d)
    d, n = d[order], n[order]
    first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]).any(1)))
    return d[first], np.add.reduceat(n, first)


def _sortable(d: np.ndarray) -> np.ndarray:
    """Rows as byte strings that compare as they do."""
    d = np.ascontiguousarray(d.astype(">u2"))
    return d.view(f"S{2 * d.shape[1]}").ravel()


_BLOCK = "range int, rows long, block binary"


def _blocks(d: np.ndarray, n: np.ndarray, bounds: np.ndarray, group: int):
    """A batch of blocks of sorted keys: digits by columns, then counts; cut at the bounds of every group-th range."""
    edges = bounds[group - 1 :: group] if group > 1 else bounds
    low = np.append(0, np.searchsorted(_sortable(d), edges, "left"))
    high = np.append(low[1:], len(d))
    some = np.flatnonzero(high > low)
    blocks = [zlib.compress(np.ascontiguousarray(d[a:b].T).tobytes() + _counts(n[a:b]), 1) for a, b in zip(low[some].tolist(), high[some].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array((high - low)[some].astype(np.int64)), pa.array(blocks, pa.binary())], names=["range", "rows", "block"])


def _counts(n: np.ndarray) -> bytes:
    narrow = int(n.max(initial=0)) < 1 << 16
    return (b"\2" + n.astype(np.uint16).tobytes()) if narrow else (b"\10" + n.astype(np.int64).tobytes())


def _opened(block: bytes, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(block)
    at = 2 * width * rows
    d = np.frombuffer(raw, np.uint16, width * rows).reshape(width, rows).T
    return d, np.frombuffer(raw, np.uint16 if raw[at] == 2 else np.int64, rows, at + 1).astype(np.int64)


class Buffer:
    """Keys and counts up to a limit; beyond it they are summed, which bounds what a task holds by its distinct keys."""

    def __init__(self, width: int):
        self.width, self.d, self.n, self.rows = width, [], [], 0

    def add(self, d: np.ndarray, n: np.ndarray) -> None:
        self.d.append(d)
        self.n.append(n)
        self.rows += len(d)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.d:
            return np.zeros((0, self.width), np.uint16), np.zeros(0, np.int64)
        d, n = np.concatenate(self.d), np.concatenate(self.n)
        self.d, self.n, self.rows = [], [], 0
        return run_lengths(d, n)


def _encoded(texts: DataFrame, words: DataFrame, s: Sizes, emit, schema: str) -> DataFrame:
    """emit(iterator of key arrays) over the texts, each task's own; the dictionary is broadcast if it is small, else joined with batches of texts."""
    spark = texts.sparkSession
    rows, size = words.agg(F.count("*"), F.sum(F.length("word"))).first()
    if rows <= s.held and (size or 0) <= s.held_bytes:
        t = words.select("lang", "word", "id").toArrow().combine_chunks()
        held = {lang: Dictionary(*_part(t, lang)) for lang in pc.unique(t["lang"]).to_pylist()}
        shared = spark.sparkContext.broadcast(held)  # at most s.held words and s.held_bytes bytes of them

        def run(batches):
            def keys():
                for b in batches:
                    for lang, column in by_language(b):
                        known = shared.value.get(lang)
                        if known:
                            for t in tokens(column):
                                yield keys_of(t, known.find(t.distinct))

            return emit(keys())

        return texts.mapInArrow(run, schema)

    # Texts in numbered batches; each distinct word of a batch meets the dictionary once, and what it finds goes to the batch.
    def number(batches):
        part = TaskContext.get().partitionId()
        for i, b in enumerate(batches):
            for j, (lang, column) in enumerate(by_language(b)):
                key = pa.array([f"{part}-{i}-{j}"] * len(column), pa.string())
                yield pa.RecordBatch.from_arrays([key, pa.array([lang] * len(column), pa.string()), column], names=["batch", "lang", "text"])

    def distinct(batches):
        for b in batches:
            for t, key, lang in _batches(b):
                for part in tokens(t):
                    word = part.distinct.cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(word), pa.string()), pa.array([lang] * len(word), pa.string()), word], names=["batch", "lang", "word"])

    dealt = cut(texts.mapInArrow(number, "batch string, lang string, text string"), "batches")
    asked = cut(dealt.mapInArrow(distinct, "batch string, lang string, word binary").distinct(), "asked")
    often = cut(words.join(asked.groupBy("lang", "word").agg(F.count("*").alias("times")), ["lang", "word"]), "often")
    told = join_spread(asked, often.select("lang", "word", "id", "times"), ["lang", "word"], "times")
    none = F.lit(None)
    both = told.select("batch", F.lit(0).alias("side"), "word", "id", none.cast("string").alias("text")).unionByName(
        dealt.select("batch", F.lit(1).alias("side"), none.cast("binary").alias("word"), none.cast("long").alias("id"), "text")
    )

    def joined(batches):
        def keys():
            key, held, known = None, [], None
            for b in batches:
                names, side = b.column("batch"), b.column("side").to_numpy()
                at = names.dictionary_encode().indices.to_numpy()
                edges = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(side, prepend=-1) != 0)).tolist() + [b.num_rows]
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    if names[lo].as_py() != key:
                        key, held, known = names[lo].as_py(), [], None
                    part = b.slice(lo, hi - lo)
                    if side[lo] == 0:
                        held.append(part)
                    elif held:
                        if known is None:
                            t = pa.Table.from_batches(held).combine_chunks()
                            known = Dictionary(t["word"].combine_chunks(), t["id"].to_numpy())
                        for t in tokens(part.column("text")):
                            yield keys_of(t, known.find(t.distinct))

        return emit(keys())

    return both.repartition("batch").sortWithinPartitions("batch", "side").mapInArrow(joined, schema)


def _part(t: pa.Table, lang: str) -> tuple[pa.Array, np.ndarray]:
    mine = t.filter(pc.equal(t["lang"], lang)).combine_chunks()
    return mine["word"].combine_chunks(), mine["id"].to_numpy()


def _batches(b: pa.RecordBatch):
    """(texts, batch, lang) of each numbered batch in an Arrow batch."""
    coded = b.column("batch").dictionary_encode()
    at = coded.indices.to_numpy()
    for i, key in enumerate(coded.dictionary.to_pylist()):
        rows = pa.array(np.flatnonzero(at == i))
        part = b.take(rows)
        yield part.column("text"), key, part.column("lang")[0].as_py()


def _bounds(texts: DataFrame, words: DataFrame, wide: bool, total: int, ranges: int, s: Sizes) -> np.ndarray:
    """ranges - 1 keys that cut the sorted keys evenly, from a sample of them: of documents, and of those documents' keys."""
    width = LONGEST * (2 if wide else 1)
    share = min(1.0, max(0.01, 4 * s.sampled / total))
    some = min(1.0, s.sampled / (share * total))

    def emit(keys):
        for k in keys:
            d = _sortable(digits(k, wide))
            if some < 1:
                h = textkit.mix((k * np.array([1, 7, 31, 127, 8191])).sum(1).astype(np.uint64) + np.arange(len(k), dtype=np.uint64) * np.uint64(textkit.FACTOR))
                d = d[h < np.uint64(int(some * 2**64))]
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array([d.tobytes()], pa.binary())], names=["keys"])

    got = _encoded(texts.sample(share, seed=5), words, s, emit, "keys binary").toArrow()
    d = np.concatenate([np.zeros(0, f"S{2 * width}"), *[np.frombuffer(k, f"S{2 * width}") for k in got["keys"].to_pylist()]])
    if not len(d):
        return d
    d.sort()
    return np.unique(d[(np.arange(1, ranges) * len(d)) // ranges])


def phrases(texts: DataFrame, words: DataFrame, least: int, s: Sizes = Sizes()) -> DataFrame:
    """(key binary, size int, n long): every phrase of 2 to LONGEST words of texts(lang, text) with n >= least occurrences.

    key: four bytes a word, big-endian, of words(lang, word, n, id), the dictionary.
    """
    spark = texts.sparkSession
    total, top = words.agg(F.sum("n"), F.max("id")).first()
    total, wide = total or 0, (top or 0) >= 1 << 16
    width = LONGEST * (2 if wide else 1)
    ranges = -(-total // s.range)
    bounds = _bounds(texts, words, wide, total, ranges, s) if ranges > 1 else np.zeros(0, f"S{2 * width}")
    ranges = len(bounds) + 1
    shared = spark.sparkContext.broadcast(bounds)  # a key of ten or twenty bytes a range
    group = -(-ranges // s.fan)

    def emit(keys):
        held = Buffer(width)
        for k in keys:
            for lo in range(0, len(k), s.keys):
                d = digits(k[lo : lo + s.keys], wide)
                held.add(d, np.ones(len(d), np.int64))
                if held.rows >= s.keys:
                    yield _blocks(*held.take(), shared.value, group)
        if held.rows:
            yield _blocks(*held.take(), shared.value, group)

    def split(batches):
        held = Buffer(width)
        for b in batches:
            for rows, block in zip(b.column("rows").to_pylist(), b.column("block").to_pylist(), strict=True):
                held.add(*_opened(block, rows, width))
                if held.rows >= s.keys:
                    yield _blocks(*held.take(), shared.value, 1)
        if held.rows:
            yield _blocks(*held.take(), shared.value, 1)

    def counted(batches):
        held, at = Buffer(width), None
        for b in batches:
            for r, rows, block in zip(b.column("range").to_pylist(), b.column("rows").to_pylist(), b.column("block").to_pylist(), strict=True):
                if r != at and held.rows:
                    yield from _runs(*held.take(), wide, least)
                at = r
                held.add(*_opened(block, rows, width))
                if held.rows >= 2 * s.range:
                    d, n = held.take()
                    held.add(d, n)
        if held.rows:
            yield from _runs(*held.take(), wide, least)

    blocks = _encoded(texts, words, s, emit, _BLOCK)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if group > 1:
        blocks = blocks.repartition(max(tasks, s.fan), "range").sortWithinPartitions("range").mapInArrow(split, _BLOCK)
    runs = blocks.repartition(max(tasks, min(ranges, 1 << 14)), "range").sortWithinPartitions("range").mapInArrow(counted, "key binary, size int, n long")
    return runs.groupBy("key", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _runs(d: np.ndarray, n: np.ndarray, wide: bool, least: int):
    """Runs of each length in sorted keys that count `least`, and the first and last ones, whatever they count."""
    ids = d.astype(np.uint32) if not wide else d[:, ::2].astype(np.uint32) << np.uint32(16) | d[:, 1::2]
    differs = np.zeros(len(ids), bool)
    differs[0] = True
    for k in range(LONGEST):
        differs[1:] |= ids[1:, k] != ids[:-1, k]
        if not k:
            continue
        first = np.flatnonzero(differs)
        sums = np.add.reduceat(n, first)
        keep = sums >= least
        keep[[0, -1]] = True
        keep &= ids[first, k] > 0
        if keep.any():
            raw = np.ascontiguousarray(ids[first[keep], : k + 1].astype(">u4")).tobytes()
            size = 4 * (k + 1)
            key = pa.array([raw[a : a + size] for a in range(0, len(raw), size)], pa.binary())
            yield pa.RecordBatch.from_arrays([key, pa.array(np.full(len(key), k + 1, np.int32)), pa.array(sums[keep])], names=["key", "size", "n"])


def _word(key: str, i: str) -> str:
    return f"substring({key}, 4 * ({i}) + 1, 4)"


def mine(docs: DataFrame, least: int = 100, top: int = 2000, s: Sizes = Sizes(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` best collocations of each language.

    Texts (null: empty; of any length) lose ASCII capitals, are split at `[.,;:!?\\x0A-\\x0D]` into pieces and these into words `[^\\x20\\x09]+`. Everything is
    by language (null: `und`, with rows that say so): n counts all words, f(phrase) its contiguous occurrences within pieces, overlaps included. Candidates
    are phrases of 2 to 5 words with a = f >= least. A cut after k words gives l = f(before), r = f(after) and floor(1000 * a * n / (l * r)); the lowest
    counts, ties to the smallest k. A candidate all of whose occurrences lie in a longer one is dropped. Order: score, then a, descending, then the phrase's bytes.
    Rows that repeat count again; other columns are ignored; an empty table, or one without frequent phrases, gives none.
    least: from 1; a phrase's numbers fit a long while 1000 * a * n has at most 38 digits.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = cut(word_counts(texts), "words")
    words = numbered(counts.where(F.col("word").isNotNull() & (F.col("n") >= least)))
    found = cut(phrases(texts, words, least, s), "phrases")

    # f of each first part and rest: the parts of a frequent phrase are frequent themselves.
    single = words.select(F.expr("substring(unhex(lpad(hex(id), 8, '0')), 1, 4)").alias("key"), F.col("n").alias("f"))
    known = single.unionByName(found.select("key", F.col("n").alias("f")))
    cuts = found.select("key", "n", F.expr("explode(sequence(1, size - 1))").alias("k"))
    sides = cut(cuts.select("key", F.col("n").alias("a"), "k", F.expr("substring(key, 1, 4 * k)").alias("before"), F.expr("substring(key, 4 * k + 1)").alias("after")), "cuts")

    def f_of(rows: DataFrame, side: str, name: str) -> DataFrame:
        uses = rows.groupBy(side).agg(F.count("*").alias("uses"))
        keyed = cut(uses.join(known.withColumnRenamed("key", side), side).withColumnRenamed("f", name), "parts")
        return join_spread(rows, keyed, [side], "uses").drop("uses")

    # The language of a phrase is that of its first word; n of it, a row a language.
    both = cut(f_of(cut(f_of(sides, "before", "l"), "sides"), "after", "r").drop("before", "after"), "sides")
    named = words.select(F.expr("substring(unhex(lpad(hex(id), 8, '0')), 1, 4)").alias("first"), "lang", F.col("word").alias("w"))
    longer = found.where("size > 2").selectExpr("n", "explode(array(substring(key, 1, 4 * (size - 1)), substring(key, 5))) as key").distinct()
    kept = found.join(longer, ["key", "n"], "left_anti").select("key", F.col("n").alias("a"))
    # joined by first words and languages, which may be hot: sums by language first
    first = kept.withColumn("first", F.expr(_word("key", "0")))
    uses = cut(first.groupBy("first").agg(F.count("*").alias("uses")).join(named.select("first", "lang"), "first"), "firsts")
    placed = cut(join_spread(first, uses, ["first"], "uses").select("key", "lang"), "kept")
    totals = counts.where("word is null").select("lang", F.col("n").alias("all"))
    weights = cut(placed.groupBy("lang").agg(F.count("*").alias("uses")).join(totals, "lang"), "totals")
    placed = join_spread(placed, weights, ["lang"], "uses").drop("uses")
    big = lambda c: f"cast({c} as decimal(18, 0))"
    score = F.expr(f"cast(1000 as decimal(4, 0)) * {big('a')} * {big('all')} div ({big('l')} * {big('r')})")
    scored = both.join(placed, "key").withColumn("score", score)
    best = scored.groupBy("lang", "key", "a", "all").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "key", "a", F.col("all").alias("n"), "b.score", "b.l", "b.r")
    best = cut(best, "scored")

    # Only what may be among the first `top` is spelled out: the score and count of the top-th, from salted parts.
    def first_of(rows: DataFrame, order: list) -> DataFrame:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(max(1, rows.count() // 100_000))))
        for by in (["lang", "salt"], ["lang"]):
            salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
        return salted.drop("salt")

    down = [F.desc("score"), F.desc("a")]
    last = first_of(best, down).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    near = cut(best.join(F.broadcast(last), "lang").where("struct(score, a) >= last").drop("last"), "near")  # a row a language
    parts = near.select("key", F.posexplode(F.expr("transform(sequence(0, length(key) div 4 - 1), i -> substring(key, 4 * i + 1, 4))")).alias("i", "first"))
    parts = cut(parts, "spelled")
    used = cut(parts.groupBy("first").agg(F.count("*").alias("uses")).join(named.select("first", "w"), "first"), "used")
    spelled = join_spread(parts, used, ["first"], "uses").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("ws"))
    phrase = F.expr("decode(unhex(array_join(transform(ws, x -> hex(x.w)), '20')), 'utf-8')")
    out = cut(near.join(spelled, "key").withColumn("phrase", phrase), "spelled")
    return first_of(out, [*down, F.asc("phrase")]).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

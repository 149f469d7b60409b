import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from veriloom.llm import collocation
from veriloom.llm.collocation import Sizes


def brute(rows, least, top):
    by: dict = {}
    for lang, text in rows:
        f = by.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 6):
                f.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in by.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in often.items():
            inside = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(100 * c >= 100 * a and inside(q) for q, c in often.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, le, r, n, -s) for i, (s, a, p, le, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def run(spark, rows, least, top, s=Sizes()):
    df = spark.createDataFrame([(lang, text, i) for i, (lang, text) in enumerate(rows)], "lang string, text string, n int").repartition(3)
    return sorted(tuple(r) for r in collocation.mine(df, least, top, s).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["of", "The", "the", "New", "york", "été", "x\x01y", "x", "naïve", "a" * 70, "São", "paulo", "it's", "\x00"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words + [f"rare{rng.randrange(3000)}"] * 2) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", " new york city ", " the end of the end of "]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), text))
    return rows + [("en", None), ("fr", ""), ("de", " . "), ("en", "aa " * 300), ("en", "b b b b b b b b b")]


def test_equals_plain_counts(spark):
    rows = corpus(1)
    want = brute(rows, 6, 2000)
    assert len(want) > 60 and {r[0] for r in want} >= {"en", "fr", "und", ""}
    assert run(spark, rows, 6, 2000) == want
    assert run(spark, rows, 6, 7) == brute(rows, 6, 7)


def test_ranges_splits_and_joined_dictionaries_change_nothing(spark):
    rows = corpus(2)
    want = brute(rows, 4, 50)
    # many ranges in two steps, small buffers; then a dictionary too large to broadcast
    assert run(spark, rows, 4, 50, Sizes(keys=100, range=60, fan=3, sampled=500)) == want
    assert run(spark, rows, 4, 50, Sizes(held=5, keys=300, range=200, fan=4, sampled=500)) == want
    assert run(spark, rows, 4, 50, Sizes(held_bytes=8)) == want


def test_nothing_to_find(spark):
    assert run(spark, [], 2, 10) == []
    assert run(spark, [("en", "one two three"), (None, None)], 2, 10) == []
    assert run(spark, [("en", "one two"), ("en", "one two")], 2, 10) == brute([("en", "one two")] * 2, 2, 10)


def test_radix_order_and_wide_keys():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 20, (3000, 5))
    keys[::3] = keys[0]
    for k, wide in ((keys, True), (keys & 0xFFFF, False)):
        d = collocation.digits(k, wide)
        assert d[collocation.radix(d)].tolist() == sorted(d.tolist())
        rows, n = collocation.run_lengths(d, np.ones(len(d), np.int64))
        assert dict(zip(map(tuple, rows.tolist()), n.tolist())) == Counter(map(tuple, d.tolist()))


def test_wide_dictionaries_count_alike(monkeypatch):
    # Numbers above 2**16 take two digits: runs are read back from both.
    ids = np.array([[70_000, 3, 0, 0, 0], [70_000, 3, 70_001, 0, 0], [70_000, 3, 70_001, 0, 0], [5, 70_000, 3, 0, 0]])
    d, n = collocation.run_lengths(collocation.digits(ids, True), np.ones(4, np.int64))
    got = {}
    for b in collocation._runs(d, n, True, 1):
        for key, size, count in zip(*(c.to_pylist() for c in b.columns)):
            got[tuple(np.frombuffer(key, ">u4").tolist())] = (size, count)
    assert got == {(5, 70_000): (2, 1), (70_000, 3): (2, 3), (5, 70_000, 3): (3, 1), (70_000, 3, 70_001): (3, 2)}


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(collocation, "_hash", lambda words: np.array([len(w) for w in words.to_pylist()], np.uint64))
    words = [b"a", b"b", b"cc", b"dd", b"eee"]
    known = collocation.Dictionary(pa.array(words, pa.binary()), np.arange(1, 6))
    asked = pa.array([b"b", b"a", b"x", b"dd", b"cc", b"eee", b"zzzzz", b""], pa.large_binary())
    assert known.find(asked).tolist() == [2, 1, 0, 4, 3, 5, 0, 0]

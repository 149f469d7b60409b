import random
import re

import numpy as np
import pytest

from veriloom.llm import substring


def brute(rows, size):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for p in range(len(w) - size + 1):
            g = tuple(w[p : p + size])
            if g in seen:
                gone.update(range(p, p + size))
            seen.add(g)
        out[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


@pytest.mark.parametrize("size,letters", [(8, 3), (20, 2), (20, 400), (4, 1)])
def test_equals_brute_force(spark, size, letters):
    rng = random.Random(size * letters)
    word = lambda: f"é{rng.randrange(letters)}"
    passages = [[word() for _ in range(n)] for n in (size - 1, size, size + 7, 3 * size)]
    rows = []
    for i in range(40):
        w = []
        for _ in range(rng.randrange(6)):
            w += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(2 * size))]
        rows.append((i * 7 % 41, " \n".join(w)))
    rows += [(100, None), (101, ""), (102, " ".join(["x"] * (3 * size))), (103, " ".join(["a", "b"] * (2 * size)))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup(docs, size).collect()}
    assert got == brute(rows, size)


def test_null_ids_and_empty_tables(spark):
    t = " ".join(f"w{i}" for i in range(30))
    got = substring.dedup(spark.createDataFrame([(None, t), (1, t), (2, t)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(None, 0), (1, 0), (2, 30)}
    assert substring.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        substring.repeats(spark.createDataFrame([(1, t)], "doc_id long, text string"), 10)


def test_tables_of_one_short_document(spark):
    size = 20
    for n in range(1, size):
        text = " ".join(f"w{i}" for i in range(n))
        got = substring.dedup(spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1), size).collect()
        assert [(r.n_words, r.n_removed, r.kept) for r in got] == [(n, 0, text)]


def test_least_in_window_of_few_values():
    for n in range(20):
        h = np.random.default_rng(n).integers(0, 1 << 60, n).astype(np.uint64)
        for span in range(1, 20):
            assert substring.least_in_window(h, span).tolist() == [min(h[i : i + span].tolist()) for i in range(n)]


def test_words_that_fool_polynomial_hashes(spark):
    a = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    b = a.translate(str.maketrans("ab", "ba"))
    side = [" ".join(f"{s}{i}" for i in range(15)) for s in "lr"]
    rows = [(1, f"{side[0]} {a} {side[1]}"), (2, f"{side[0]} {b} {side[1]}")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 20) and got[2][1] == 0


def test_digests_are_of_words(monkeypatch):
    """Hashes only choose candidates: with all of them equal, stretches and windows still differ by their words."""
    import pyarrow as pa

    from veriloom.llm import textkit

    monkeypatch.setattr(textkit, "grams", lambda w, k: (np.zeros(len(w.hash), np.uint64), textkit.in_one(w, k)))
    rng = random.Random(4)
    words = [[f"w{rng.randrange(9)}" for _ in range(n)] for n in (20, 31, 31, 8, 40)] + [[]]
    words += [words[1], words[0] + words[1]]
    text = pa.array(["  ".join(w) + "\n" for w in words])
    ids = pa.array(range(len(words)))
    batch = pa.RecordBatch.from_arrays([ids, text, pa.array([[0]] * len(words), pa.list_(pa.int64()))], names=["id", "text", "hs"])
    got = next(substring._stretches(10, 20)(iter([batch]))).to_pylist()
    assert [(r["id"], r["at"], r["n"]) for r in got] == [(i, 0, len(w) - 19) for i, w in enumerate(words) if len(w) >= 20]
    for x in got:
        for y in got:
            assert (x["d1"] == y["d1"] and x["d2"] == y["d2"]) == (words[x["id"]] == words[y["id"]])
    parts = pa.array([[{"at": 0, "n": len(w) - 19}] if len(w) >= 20 else [] for w in words], pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))
    rows = [r for b in substring._windows(20)(iter([pa.RecordBatch.from_arrays([ids, text, parts], names=["id", "text", "parts"])])) for r in b.to_pylist()]
    assert len(rows) == sum(max(0, len(w) - 19) for w in words)
    for x in rows:
        for y in rows:
            same = words[x["id"]][x["at"] : x["at"] + 20] == words[y["id"]][y["at"] : y["at"] + 20]
            assert (x["d1"] == y["d1"] and x["d2"] == y["d2"]) == same


def test_a_long_text_and_repeated_ids(spark):
    rng = random.Random(6)
    many = [f"v{rng.randrange(40_000)}" for _ in range(50_000)]
    rows = [(5, " ".join(many)), (6, " ".join(["new", *many[20_000:20_500], "end"])), (9, " ".join([*many[:30], *many[:30]]))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 20)
    t = " ".join(many[:40])
    twice = substring.dedup(spark.createDataFrame([(1, t), (2, t), (2, "a b c")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in twice) == [(1, 40, 0), (2, 3, 3), (2, 40, 40)]

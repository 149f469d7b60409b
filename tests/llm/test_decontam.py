import random
import re

from veriloom.llm import decontam


def plain_tiling(a, b, least):
    """Greedy string tiling as first described: again and again the longest unmarked common run, ties by place."""
    in_a, in_b, total = [False] * len(a), [False] * len(b), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not in_a[i + n] and not in_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return total
        n, i, j = best
        in_a[i : i + n] = in_b[j : j + n] = [True] * n
        total += n


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())


def test_tiling_equals_plain_tiling(spark):
    rng = random.Random(1)
    items = [(k, " ".join(f"w{rng.randrange(6 if k % 2 else 500)}" for _ in range(rng.randrange(3, 30)))) for k in range(12)] + [(90, ""), (91, None)]
    docs = []
    for d in range(40):
        w = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(30))]
        src = words(rng.choice(items)[1])
        cut = rng.randrange(len(src) + 1)
        w += src[cut:] + ["zz"] + src[:cut] if d % 2 else src
        docs.append((d, " ".join(w).upper() if d % 3 else " ".join(w)))
    docs += [(200, None), (201, "")]
    got = {(r.doc_id, r.item_id): r.tiled_words for r in decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, k): n for d, t in docs for k, x in items if (n := plain_tiling(words(x), words(t), 5))}
    assert got == want


def test_reordered_passages_are_caught_and_clean_texts_are_not(spark):
    rng = random.Random(2)
    item = [f"q{i}" for i in range(36)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    moved = noise(20) + item[18:] + noise(5) + item[:9] + noise(3) + item[9:18]
    rows = [(1, moved), (2, noise(200)), (3, noise(9) + item[:10] + noise(9)), (4, item)]
    docs = spark.createDataFrame([(i, " ".join(w), "x") for i, w in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, " ".join(item), 1)], "item_id long, text string, doc_id int")
    assert {(r.doc_id, r.item_id, r.tiles) for r in decontam.contaminated(docs, bench).collect()} == {(1, 7, 3), (4, 7, 1)}


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PASS_SEEDS", 20)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(12))) for k in range(9)]
    docs = [(k, "a b " + t + " c") for k, t in items] + [(50, "nothing here at all to see")]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, k) for k in range(9)}


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(d, b).count() == 0
    assert decontam.contaminated(spark.createDataFrame([(1, "a b c d e f"), (None, "x")], "doc_id long, text string"), b).count() == 0


def test_items_of_few_words_are_caught_whole(spark):
    items = [(1, "Four words of it"), (2, "lone"), (3, "two words"), (4, "two words"), (5, "five words are long enough"), (6, "")]
    docs = [(1, "a b FOUR words\nof it"), (2, "four words of"), (3, "it lone two"), (4, "words"), (5, "two words two words"), (6, "it has five words are long enough"), (7, None)]
    got = {(r.doc_id, r.item_id, r.tiles, r.tiled_words, r.item_words, r.coverage) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1, 1, 4, 4, 1.0), (3, 2, 1, 1, 1, 1.0), (5, 3, 1, 2, 2, 1.0), (5, 4, 1, 2, 2, 1.0), (6, 5, 1, 5, 5, 1.0)}


def test_words_decide_where_hashes_are_equal(spark):
    a = [b"%d" % i for i in range(30)]
    b = list(a)
    b[12] = b"x"
    assert decontam.true_runs([(0, 0, 30), (2, 2, 5)], a, b, 5) == [(0, 0, 12), (13, 13, 17), (2, 2, 5)]
    assert decontam.true_runs([(8, 8, 7)], a, b, 5) == [] and decontam.true_runs([(0, 1, 9)], a, b, 5) == []
    got = {r.doc_id: (r.item_id, r.tiles, r.tiled_words) for r in decontam.overlaps(*_tables(spark), floor=0.5, short=True).collect()}
    assert got == {1: (1, 1, 12), 2: (1, 2, 12), 5: (2, 1, 3)}


def _tables(spark):
    item = [f"w{i}" for i in range(12)]
    docs = [(1, " ".join(["x", *item, "y"])), (2, " ".join([*item[6:], "z", *item[:6]])), (3, " ".join(f"v{i}" for i in range(30))), (4, None), (5, "q A b C r"), (6, "a b x c")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item)), (2, "a B c")], "item_id long, text string")


def test_repeated_rows_and_long_texts(spark):
    item = " ".join(f"w{i}" for i in range(20))
    long = "a " * 100_000 + item
    docs = spark.createDataFrame([(1, long), (1, long), (2, "a " * 50_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "a a a a a a b b b b b b b")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.tiled_words) for r in decontam.contaminated(docs, bench).collect())
    assert got == [(1, 1, 20), (1, 1, 20)]


def runs_of(item, text, least):
    """The operator's parts for one item and one text."""
    import numpy as np
    import pyarrow as pa

    from veriloom.llm import textkit

    s = decontam.seeds([1], [" ".join(item)], least)
    (w,) = textkit.words(pa.array([" ".join(text)]), lower=True, most=1 << 60)
    h, whole = textkit.grams(w, least)
    at = np.flatnonzero(whole)
    p = decontam.Places(h[at], at)
    return s, p, p.find(s.hash)


def test_runs_by_diagonals_are_all_runs(monkeypatch):
    rng = random.Random(6)
    every = lambda number, p: sorted(r for a, b, n in decontam.runs_between(number, p, 3) for r in zip(a.tolist(), b.tolist(), n.tolist()))
    for k in range(60):
        item, text = ([f"{rng.choice('abc' if k % 2 else 'ab')}" for _ in range(rng.randrange(5, 40))] for _ in range(2))
        _, p, number = runs_of(item, text, 3)
        want = []
        for i in range(len(item)):
            for j in range(len(text)):
                if i and j and item[i - 1] == text[j - 1]:
                    continue
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]:
                    n += 1
                want += [(i, j, n)] if n >= 3 else []
        for most in (1 << 20, 20, 1):
            monkeypatch.setattr(decontam, "PAIRS", most)
            assert every(number, p) == sorted(want)


def test_bands_tile_as_all_runs_at_once(monkeypatch):
    rng = random.Random(7)
    for k in range(60):
        item, text = ([rng.choice("abc" if k % 2 else "ab").encode() for _ in range(rng.randrange(5, 60))] for _ in range(2))
        plain = ([x.decode() for x in item], [x.decode() for x in text])
        _, p, number = runs_of(*plain, 3)
        monkeypatch.setattr(decontam, "PAIRS", 1 << 20)
        want = decontam.tile(item, text, number, p, 3)
        assert sum(t[2] for t in want) == plain_tiling(*plain, 3)
        monkeypatch.setattr(decontam, "PAIRS", 1)
        monkeypatch.setattr(decontam, "BAND", rng.choice((1, 4, 50)))
        assert sorted(decontam.tile(item, text, number, p, 3)) == sorted(want)


def test_keys_never_miss_a_covering_text(spark):
    rng = random.Random(12)
    prompt = [f"p{i}" for i in range(8)]
    items = [(k, prompt + [f"i{rng.randrange(30)}" for _ in range(rng.randrange(0, 40))]) for k in range(60)]
    docs = [(d, rng.choice(items)[1][rng.randrange(12) :] + prompt[: rng.randrange(9)] + [f"i{rng.randrange(30)}" for _ in range(20)]) for d in range(60)]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string"), spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")).collect()}
    want = {(d, k) for d, t in docs for k, x in items if plain_tiling(x, t, 5) >= 0.6 * len(x)}
    assert got == want and want


def test_many_items_that_begin_alike_and_texts_that_repeat():
    import time

    import numpy as np
    import pyarrow as pa

    from veriloom.llm import textkit

    n = 100_000
    prompt = "answer the following question with one of these words"
    s = decontam.seeds(list(range(n)), [f"{prompt} " + " ".join(f"i{i}w{j}" for j in range(25)) for i in range(n)], 5, 0.6)
    (w,) = textkit.words(pa.array([prompt + " and more text that is of no item at all"]), lower=True)
    h, whole = textkit.grams(w, 5)
    at = np.flatnonzero(whole)
    began = time.time()
    p = decontam.Places(h[at], at)
    for _ in range(20):
        assert not len(decontam.covering(decontam.items_of(p, s), p, s, 0.6))
    assert time.time() - began < 5

    import tracemalloc

    text = ["a", "b"] * 1_250_000 + ["c"]  # 5 MB
    encoded = [x.encode() for x in text]
    for item, n, covered in ((["a", "b"] * 1500, len(text), 3000), (["a", "b"] * 700 + ["x"] + ["b", "a"] * 800, 40_001, 3000)):
        _, p, number = runs_of(item, text[:n], 5)
        began = time.time()
        tracemalloc.start()
        got = decontam.tile([x.encode() for x in item], encoded[:n], number, p, 5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(t[2] for t in got) == covered and time.time() - began < 60 and peak < 400 << 20

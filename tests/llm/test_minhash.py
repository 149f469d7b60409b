import random
import re

import numpy as np
import pytest

from veriloom.llm import minhash, textkit


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out, passage = [], [word() for _ in range(12)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice((1, 2, 3, 5, 20, 60, 120)))]
        out.append(base)
        for _ in range(rng.choice((0, 1, 6, 12))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 5))):
                copy[rng.randrange(len(copy))] = word()
            out.append(copy)
    out += [[word() for _ in range(10)] + passage + [word() for _ in range(10)] for _ in range(25)]
    texts = [" ".join(x) for x in out] + ["", None, "  \n", "A  b\tC d", "a b c\nd", "x", "X"]
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.groups(docs, minhash.Plan(words=k, percent=percent)).collect()}
    assert got == brute(rows, k, percent)


def test_chain_of_links_beyond_the_first_node(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(40):
        base = list(base)
        base[rng.randrange(80)] = f"x{i}"
        rows.append((100 - i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.groups(docs, minhash.Plan(words=3, percent=85)).collect()}
    assert got == brute(rows, 3, 85)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None), (3, "a b c d")]
    got = sorted(minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (1, 1, True), (2, 2, True), (3, 1, False), (None, None, True)]
    assert minhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = x[:2000], x[400:2400]  # similarity 1600 / 2400
    sets = [a, b, x[:1], x[:3]]
    off = np.cumsum([0] + [len(s) for s in sets])
    c = minhash.sketch(np.concatenate(sets), off, 512)
    assert (c != textkit.U(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((c[0] == c[1]).mean() - 2 / 3) < 0.08
    assert minhash.Plan(words=3, percent=85).bands == 22


def thue_morse(n):
    """Two words that polynomial hashes modulo 2 ** 64 can't tell apart."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_that_fool_polynomial_hashes(spark):
    a, b = thue_morse(1024)
    rows = [(1, a), (2, b), (3, f"x {a} y"), (4, f"x {b} y"), (5, a.upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Plan(words=3, percent=85)).collect()}
    assert got == brute(rows, 3, 85) and got[2] == (1, 2, True)


def test_blocks_link_by_words_alone():
    """A block's rows hold texts, no hashes; its links connect what brute force connects, however batches cut it."""
    import pyarrow as pa

    rows = [(i, t or "") for i, t in corpus(8)]
    want = {i: c for i, (_, c, _) in brute(rows, 3, 85).items()}
    cols = ("key", "cls", "i", "j", "side", "id", "label", "text")
    table = [(k, 0, 0, 0, side, i, i, t.encode()) for k in (1, 2) for side in (0, 1) for i, t in rows]
    arrays = [pa.array(c, pa.binary() if n == "text" else pa.int64()) for n, c in zip(cols, zip(*table, strict=True), strict=True)]
    batch = pa.RecordBatch.from_arrays(arrays, names=cols)
    for size in (len(table), 7, len(table) // 2):
        batches = [batch.slice(a, size) for a in range(0, len(table), size)]
        links = [(u, v) for b in minhash._block_links(85, 3)(iter(batches)) for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        comp = {i: i for i in want}

        def root(x, comp=comp):
            while comp[x] != x:
                x = comp[x]
            return x

        for u, v in links:
            assert want[u] == want[v]
            x, y = sorted((root(u), root(v)))
            comp[y] = x
        assert {i: root(i) for i in comp} == want


def test_exact_runs_number_words_not_hashes():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(5 if i % 2 else 5000)}" for _ in range(rng.choice((0, 1, 2, 4, 6, 300)))) for i in range(40)] + ["a b", "b a", "a b"]
    for k in (1, 3, 5, 20):
        exact = textkit.Exact()
        got = exact.runs(exact.words([t.encode() for t in texts]), k)
        for i, x in enumerate(texts):
            assert len(got[i]) == len(shingles(x, k))
            for j, y in enumerate(texts):
                assert len(np.intersect1d(got[i], got[j])) == len(shingles(x, k) & shingles(y, k))


def test_repeated_ids_of_other_texts_and_a_long_text(spark):
    long = " ".join(f"w{i % 7001}x{i}" for i in range(60_000))
    rows = [(4, long), (7, "p q r s"), (7, long + " tail"), (9, "p q r s"), (11, "u v w x y z")]
    got = sorted((r.doc_id, r.component_id) for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Plan(words=3, percent=85)).collect())
    assert got == [(4, 4), (7, 4), (7, 4), (9, 4), (11, 11)]


def test_hot_keys_join_by_broadcast(spark, monkeypatch):
    from veriloom.llm import shared

    monkeypatch.setattr(shared, "HOT_LEAST", 5)
    monkeypatch.setattr(shared, "HOT_KEYS", 4)
    rows = spark.createDataFrame([(i, 0 if i % 2 else i % 40) for i in range(200)] + [(900, None)], "id long, k long")
    keyed = rows.where("k is not null and k <> 6").groupBy("k").count().withColumn("v", rows.k + 1)
    for how, n in (("inner", 200 - 5), ("left", 201)):
        got = shared.join_spread(rows, keyed, ["k"], "count", how).collect()
        assert len(got) == n and all(r.v == (None if r.k in (6, None) else r.k + 1) for r in got)


def test_a_full_filter_only_passes_more(spark, monkeypatch):
    from veriloom.llm import shared

    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text")
    gone = spark.range(0, 3000, 3)
    monkeypatch.setattr(shared, "BLOOM_LEAST", 6)
    words = shared.bloom(gone, "id", 6)
    assert words.count() == 1 and shared.flagged(docs, docs.doc_id, words, "hit").where("hit").count() == 3000
    monkeypatch.setattr(shared, "BLOOM_MOST", 6)
    assert {r.doc_id for r in shared.without(docs, gone).collect()} == {i for i in range(3000) if i % 3}


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from veriloom.session import scratch

    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    with pytest.raises(ValueError):
        scratch(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")), "x")

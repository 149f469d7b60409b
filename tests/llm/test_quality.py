import math
import random
import zlib

import numpy as np
import pyarrow as pa

from veriloom.llm import quality

GOOD, BAD = "the of and to in is that for it with".split(), "zap *** $$$ buy!!! &&& www".split()


def made(rng, good):
    words = [rng.choice(GOOD) + rng.choice(["", "er", "ly", "ing"]) for _ in range(rng.randrange(5, 80))]
    if not good:
        words = [w + rng.choice(["***", "&&&", ""]) for w in words] if rng.random() < 0.5 else [words[0]] * len(words)
    return " ".join(words)


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    return [(i, made(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(n)]


def test_held_out_documents_are_ranked_and_cut(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows], "doc_id long, text string, score int")
    fold = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if not fold(i)], "doc_id long, quality int")
    ranking = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.score(docs, ranking).collect()}
    held = [(got[i], y) for i, _, y in rows if fold(i)]
    assert len(held) > 100 and sum(r["keep"] == (y == 1) for r, y in held) >= 0.95 * len(held)
    assert all(r["keep"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())
    ups, lows = [r["score"] for r, y in held if y], [r["score"] for r, y in held if not y]
    assert sum(a > b for a in ups for b in lows) > 0.98 * len(ups) * len(lows)


def test_training_is_pairs_only_and_the_cut_a_quantile():
    rows = corpus(200, 3)
    y = np.array([r[2] for r in rows])
    parts = list(quality.measures(pa.array([r[1] for r in rows])))
    dense, doc, slot = parts[0][1], parts[0][2], parts[0][3]
    s = quality.Settings(epochs=3, batch=16)
    r = quality.train(dense, doc, slot, y, 0.25, s)
    # the same by plain loops over pairs
    at, index, value = quality.entries(dense, doc, slot, r.edges)
    feature = [{} for _ in rows]
    for d, i, x in zip(at, index, value):
        feature[d][int(i)] = feature[d].get(int(i), 0) + x
    rng = np.random.default_rng(s.seed)
    w, held = np.zeros(len(r.w)), np.full(len(r.w), 1e-2)
    for _ in range(s.epochs):
        up, low = quality.pairs_of(y, rng)
        assert (y[up] == 1).all() and (y[low] == 0).all() and set(up) | set(low) == set(range(len(y)))
        for a in range(0, len(up), s.batch):
            g = s.decay * w
            some = list(zip(up[a : a + s.batch], low[a : a + s.batch]))
            for i, j in some:
                d = {k: feature[i].get(k, 0) - feature[j].get(k, 0) for k in feature[i].keys() | feature[j].keys()}
                p = 1 / (1 + math.exp(sum(w[k] * x for k, x in d.items())))  # what the pair's loss pulls with
                for k, x in d.items():
                    g[k] -= p * x / len(some)
            held += g * g
            w = w - s.rate * g / np.sqrt(held)
    assert np.allclose(w, r.w, atol=1e-9)
    strength = r.strength(dense, doc, slot)
    assert abs((strength < r.quantile).mean() - 0.25) <= 2 / len(y)
    assert quality.LIMIT == r.score(np.array([r.quantile]))[0]


def test_measures_of_edge_texts():
    for row, dense, doc, slot in quality.measures(pa.array([None, "", "  \n", "a", "a b\na b\nc", "x" * 300_000])):
        assert dense.shape == (6, len(quality.MEASURES)) and np.isfinite(dense).all()
        name = quality.MEASURES.index
        assert dense[4, name("distinct words")] == 3 / 5 and dense[4, name("distinct lines")] == 2 / 3 and dense[4, name("commonest word")] == 2 / 5
        assert dense[3, name("distinct lines")] == 1 and dense[5, name("long words")] == 1
        assert set(doc.tolist()) == {3, 4, 5}


def test_nulls_repeats_one_label_and_empty(spark):
    schema = "doc_id long, text string, id int"
    docs = spark.createDataFrame([(1, None, 0), (1, "a b", 0), (None, "", 1), (2, "a b", 2)], schema)
    for labels, want in (([], 0.5), ([(1, 1), (None, 0), (2, None)], 1.0), ([(1, 0), (1, 1)], 0.0)):
        got = quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))).collect()
        assert len(got) == 4 and {r["score"] for r in got} == {want}
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, both)).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) <= 2
    assert quality.score(docs.limit(0), quality.fit(docs, both)).count() == 0


def test_all_labelled_rows_are_learned_from(spark):
    rows = corpus(400, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    s = quality.Settings(each=20, epochs=2)
    ranking = quality.fit(docs, labels, s)
    # Every word of a labelled row has a weight.
    _, dense, _, slot = next(iter(quality.measures(pa.array([r[1] for r in rows]))))
    assert (ranking.w[np.unique(slot)] != 0).all()
    strength = np.sort([r["strength"] for r in quality.score(docs, ranking).collect()])
    assert abs(strength[100] - ranking.quantile) < 1e-12  # 100 rows of label 0, of 400
    edges = np.sort(dense, axis=0)
    assert all(abs(ranking.edges[k][3] - edges[199, k]) < 1e-12 for k in range(len(quality.MEASURES)))
    y = spark.createDataFrame([(i, y) for i, _, y in rows], "id long, y int")
    for n in ({0: 100, 1: 300}, {0: 300, 1: 100}):
        parts = {}
        for r in quality.dealt(y if n[1] == 300 else y.selectExpr("id", "1 - y as y"), n, 20).collect():
            parts.setdefault(r["part"], []).append((r["id"], r["y"]))
        more = 1 if n[1] == 300 else 0
        assert len(parts) == 15 and {i for p in parts.values() for i, _ in p} == set(range(400))
        assert sum(k == more for p in parts.values() for _, k in p) == 300 and all(any(k != more for _, k in p) for p in parts.values())
    again = quality.fit(docs, labels, s)
    assert (again.w == ranking.w).all() and again.quantile == ranking.quantile and again.slope == ranking.slope

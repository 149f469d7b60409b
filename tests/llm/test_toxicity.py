import random

import numpy as np

from veriloom.llm import toxicity as tx


def corpus(n, seed=0):
    """An insult is toxic beside a group's name; either alone is only now and then."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 60))]
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        w += ["vermin"] * insult + ["groupname"] * group
        rng.shuffle(w)
        docs.append((i, " ".join(w), "x"))
        labels.append((i, int(insult and group)))
    return docs, labels


def test_pairs_of_terms_are_learned_and_held_out_rows_are_right(spark):
    docs, labels = corpus(1500)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    la = spark.createDataFrame(labels, "doc_id long, toxic int")
    m = tx.fit(d, la.where("doc_id % 5 <> 0"), tx.Settings(epochs=30))
    got = {r.doc_id: r.score for r in tx.score(d, m).collect()}
    held = [(got[i], y) for i, y in labels if i % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.97
    assert set(got) == {i for i, _ in labels} and all(0 <= s <= 1 for s in got.values())
    clean = {r.doc_id for r in tx.keep_clean(d, m).collect()}
    assert clean == {i for i, s in got.items() if s < 0.5}


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = tx.Machine(np.zeros(1, np.int32), -0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    terms = [np.array([0, 3, 8]), np.array([], int), np.array([2])]
    doc = np.repeat(np.arange(3), [len(t) for t in terms])
    got = m.score(doc, np.concatenate(terms).astype(int), 3)
    for t, p in zip(terms, got, strict=True):
        z = m.w0 + m.w[t].sum() + sum(m.v[i] @ m.v[j] for a, i in enumerate(t) for j in t[a + 1 :])
        assert abs(1 / (1 + np.exp(-z)) - p) < 1e-12


def test_nulls_repeats_no_labels_and_empty(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "vermin"), (3, "word " * 50_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    none = tx.fit(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert tx.score(d, none).count() == 5 and tx.keep_clean(d, none).count() == 5
    odd = tx.fit(d, spark.createDataFrame([(None, 1), (1, None), (1, 0), (3, 1), (3, 0)], "doc_id long, toxic int"))
    assert tx.score(d, odd).count() == 5 and tx.score(d.limit(0), odd).count() == 0


def test_training_equals_plain_loops():
    rng = np.random.default_rng(2)
    s = tx.Settings(epochs=3, factors=3)
    terms = [np.sort(rng.choice(12, rng.integers(0, 6), replace=False)) for _ in range(300)]
    y = rng.integers(0, 2, 300).astype(float)
    weight = np.where(y > 0, 2.0, 1.0)
    slots = np.full(1 << tx.BITS, -1, np.int32)
    slots[:12] = np.arange(12)
    doc = np.repeat(np.arange(300), [len(t) for t in terms])
    m = tx.train(doc, np.concatenate(terms).astype(np.int64), y, weight, slots, s)
    # The same steps, a document and a term at a time.
    draw = np.random.default_rng(s.seed)
    p = (weight * y).sum() / weight.sum()
    w0, w, v, share = np.log(p / (1 - p)), np.zeros(12), draw.normal(0, 0.01, (12, 3)), weight / weight.mean()
    g0, gw, gv = 1.0, np.ones(12), np.ones((12, 3))
    for _ in range(3):
        order = draw.permutation(300)
        for a in range(0, 300, 256):
            d0, dw, dv, used = 0.0, np.zeros(12), np.zeros((12, 3)), set()
            rows = order[a : a + 256]
            for r in rows:
                t = terms[r]
                z = w0 + sum(w[i] for i in t) + sum(v[i] @ v[j] for x, i in enumerate(t) for j in t[x + 1 :])
                e = (1 / (1 + np.exp(-z)) - y[r]) * share[r]
                d0 += e / len(rows)
                for i in t:
                    used.add(int(i))
                    dw[i] += e
                    dv[i] += e * sum(v[j] for j in t if j != i)
            g0 += d0 * d0
            w0 -= s.rate * d0 / np.sqrt(g0)
            for i in used:
                dw[i] += s.decay * 300 * w[i]
                dv[i] += s.decay * 300 * v[i]
                gw[i] += dw[i] ** 2
                gv[i] += dv[i] ** 2
                w[i] -= s.rate * dw[i] / np.sqrt(gw[i])
                v[i] -= s.rate * dv[i] / np.sqrt(gv[i])
    assert abs(m.w0 - w0) < 1e-9 and np.allclose(m.w, w, atol=1e-9) and np.allclose(m.v, v, atol=1e-9)


def test_terms_that_are_neutral_alone_are_kept_for_their_pairs(spark):
    import random

    rng = random.Random(13)
    noise = lambda: " ".join(f"n{rng.randrange(40)}" for _ in range(6))
    rows = []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        rows.append((i, f"{'alpha' if a else 'gamma'} {noise()} {'bravo' if b else 'delta'}", int(a == b)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, toxic int")
    machine = tx.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in tx.score(docs, machine).collect()}
    held = [(got[i] >= 0.5) == (y == 1) for i, _, y in rows if i % 5 == 0]
    assert sum(held) >= 0.95 * len(held)

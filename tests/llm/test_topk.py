import math
import random

from veriloom.llm import topk


def brute(rows, k, every=20):
    use = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(use):
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(use[q], v)), i) for i, v in use.items() if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return out


def run(spark, rows, **more):
    v = spark.createDataFrame([(i, x, 0) for i, x in rows], "vec_id long, embedding array<float>, score int")
    return sorted(tuple(r) for r in topk.search(v, v.where("vec_id % 20 = 0"), **more).collect())


def test_equals_brute_force_over_blocks(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice((-0.5, 0.25, rng.uniform(-1, 1))) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 340)] + [(400, [0.0] * 8)]
    rows += [(500, None), (501, [None] * 8), (502, [float("nan")] + [0.1] * 7), (520, [float("inf")] * 8), (None, [0.1] * 8)]
    for blocks in ((8192, 2048), (37, 5)):
        assert run(spark, rows, k=7, candidates_block=blocks[0], queries_block=blocks[1]) == brute(rows, 7)


def test_few_candidates_huge_components_and_empty(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0])], k=5) == [(0, 1, 1, 4096)]
    big = run(spark, [(0, [3e30, 1.0]), (1, [3e30, 0.0]), (2, [-3e30, 0.0])], k=5)
    assert [r[2:] for r in big] == [(1, (1 << 63) - 1), (2, -(1 << 63))]
    assert run(spark, []) == []


def test_the_walk_stops_early_when_the_bound_allows():
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(0, 20, (5000, 3)))
    lists = topk.Lists(np.arange(5000), x)
    ids, scores, depth = lists.search(-1, np.array([50.0, 1.0, 0.0]), 5)
    order = np.lexsort((np.arange(5000), -(x @ [50.0, 1.0, 0.0])))[:5]
    assert (ids == order).all() and depth < 1000


def test_bounds_carry_over_blocks_and_streams(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) * (5 if i % 50 == 0 else 1) for _ in range(6)]) for i in range(700)] + [(i, [0.25] * 6) for i in range(700, 760)]
    rows += [(i % 30, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(40)] + [(3, [0.5] * 4), (40, [9.0] * 9)]
    least: dict = {}
    for i, v in rows:
        v = [math.floor(64 * x) / 64 for x in v]
        least[i] = min(least.get(i, v), v)
    want = brute([(i, [*v, *[0.0] * (9 - len(v))]) for i, v in least.items()], 5)
    assert run(spark, rows, k=5, candidates_block=20, queries_block=7, stream=90) == want
    assert run(spark, rows, k=5) == want


def test_a_known_bound_ends_walks_at_once():
    import numpy as np

    rng = np.random.default_rng(1)
    near, far = np.floor(rng.normal(0, 60, (3000, 4))), np.floor(rng.normal(0, 3, (3000, 4)))
    g = topk.Group(np.array([-1, -2]), np.array([[40.0, 1.0, 0.0, 2.0], [-3.0, 30.0, 1.0, 0.0]]), [None, None], 5)
    g.meet(np.arange(3000), near)
    walked = len(g.depths)
    g.meet(np.arange(3000, 6000), far)
    assert len(g.depths) == walked  # no list of the second block was walked
    for r in range(2):
        s = np.concatenate([near, far]) @ g.q[r]
        assert g.best[r][0].tolist() == np.lexsort((np.arange(6000), -s))[:5].tolist()


def test_every_query_of_the_given_tables_is_answered_by_walks():
    import os

    import numpy as np
    import pyarrow.parquet as pq
    import pytest

    for sf in ("sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}/embeddings.parquet"
        if not os.path.exists(path):
            pytest.skip("no tables here")
        t = pq.read_table(path).sort_by("vec_id")
        ids = t["vec_id"].to_numpy()
        x = np.floor(np.array(t["embedding"].to_pylist(), np.float64) * 64)
        mine = ids % 20 == 0
        g = topk.Group(ids[mine], x[mine], [None] * int(mine.sum()), 20)
        g.meet(ids, x)
        assert len(g.depths) == mine.sum()  # one walk a query; in 64 dimensions without a dominant one no bound falls before all is seen
        for r, i in enumerate(ids[mine]):
            s = x @ x[mine][r]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:20]
            assert g.best[r][0].tolist() == ids[order].tolist() and g.best[r][1].tolist() == s[order].tolist()


def test_walks_in_step_end_one_by_one():
    import numpy as np

    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(0, 30, (6000, 5)) * np.array([1, 1, 8, 1, 1]))
    q = np.floor(rng.normal(0, 30, (40, 5)))
    q[0], q[1] = 0, [0, 0, 90, 0, 0]
    g = topk.Group(np.arange(-40, 0), q, [None] * 40, 7)
    g.meet(np.arange(6000), x)
    assert len(g.depths) == 40 and g.stopped >= 38 and len(set(g.depths)) > 2 and min(g.depths) < 100
    for r in range(40):
        s = x @ q[r]
        assert g.best[r][0].tolist() == np.lexsort((np.arange(6000), -s))[:7].tolist()

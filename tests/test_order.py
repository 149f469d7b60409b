import random

import pytest
from pyspark.sql import functions as F

from veriloom.operators import nearby, ordered, patience


def rows_of(seed, n=400):
    rng = random.Random(seed)
    return [(i, rng.randrange(90), rng.randrange(20), rng.choice([1, None, -3, 7])) for i in range(n)]


def test_places_sums_and_the_row_before(spark):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "id long, at long, k int, v int").repartition(5)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    o = ordered.Ordered(df, ["at", "id"], parts=7)
    assert {r["id"]: r["place"] for r in o.placed().collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    total, with_, without = 0, {}, {}
    for r in order:
        without[r[0]] = total
        total += r[3] or 0
        with_[r[0]] = total
    assert {r["id"]: r["s"] for r in o.sums(s=F.col("v")).collect()} == with_
    assert {r["id"]: r["s"] for r in o.sums(exclusive=True, s=F.col("v")).collect()} == without
    assert {r["id"]: (r["b"], r["c"]) for r in o.before(b="id", c="v").collect()} == {r[0]: ((order[i - 1][0], order[i - 1][3]) if i else (None, None)) for i, r in enumerate(order)}
    plan = o.placed()._jdf.queryExecution().executedPlan().toString() + o.sums(s=F.col("v"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert ordered.placed(df.limit(0), ["at"]).count() == 0


def test_budget_and_chain(spark):
    rows = [(i, i % 3 == 0, i == 31, f"h{i}", f"h{i - 1}" if i and i % 9 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, ok boolean, bad boolean, h string, p string").repartition(4)
    run = lambda s, m: sorted(r["i"] for r in ordered.within_budget(df, ["i"], F.col("ok"), F.col("bad"), s, m).collect())
    assert run(5, 100) == list(range(13)) and run(100, 7) == list(range(7)) and run(100, 100) == list(range(32))
    assert sorted(r["i"] for r in ordered.chain_breaks(df, ["i"], "h", "p").collect()) == [i for i in range(1, 60) if i % 9 == 0]


@pytest.mark.parametrize("within", [1, 5, 40])
def test_asof_forward(spark, within):
    rng = random.Random(within)
    left = [(i, rng.choice("ab"), rng.randrange(-50, 200)) for i in range(150)] + [(900, None, 3), (901, "a", None), (901, "a", 3)]
    right = [(rng.choice("ab"), rng.randrange(-50, 260), rng.randrange(1000)) for _ in range(60)] + [("a", None, 1), (None, 3, 2)]
    got = nearby.asof_forward(spark.createDataFrame(left, "id int, k string, at int"), spark.createDataFrame(right, "k string, pos int, x int"), "k", "at", "pos", within, ["x", "pos"])
    want = []
    for i, k, at in left:
        hits = [(p, x) for kk, p, x in right if k is not None and at is not None and kk == k and p is not None and at <= p < at + within]
        p, x = min(hits) if hits else (None, None)
        want.append((i, k, at, x, p))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_points_and_sums_in_ranges(spark):
    rng = random.Random(3)
    points = [(i, rng.choice([7, 7, 7, rng.randrange(-40, 90)])) for i in range(200)] + [(999, None)]
    ranges = [(100 + i, a := rng.randrange(-40, 90), a + rng.randrange(-2, 25)) for i in range(40)] + [(500, 7, 7), (501, 7, 7), (502, 7, 7)]
    p, r = spark.createDataFrame(points, "i int, at int"), spark.createDataFrame(ranges, "r int, low int, high int")
    want = sorted((i, j) for i, at in points for j, a, b in ranges if at is not None and a <= at <= b)
    for most in (None, (5, 2)):
        got = nearby.points_in_ranges(p, r, "at", "low", "high", "i", "r", 10, most)
        assert sorted((x["i"], x["r"]) for x in got.collect()) == want
        assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    sums = {x["r"]: (x["n"], x["s"]) for x in nearby.sums_in_ranges(p, r, "at", "low", "high", n=F.lit(1), s=F.col("i")).collect()}
    assert sums == {j: (sum(1 for i, k in want if k == j), sum(i for i, k in want if k == j)) for j, _, _ in ranges}


def test_sides_of_a_range_join_are_computed_once_and_neither_is_broadcast(spark):
    p = spark.range(300).selectExpr("id as i", "id % 2 as at")
    r = spark.range(50).selectExpr("id as r", "0L as low", "1L as high")
    got = nearby.points_in_ranges(p, r, "at", "low", "high", "i", "r", 4, (5, 2))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in text and "SortMergeJoin" in text
    assert got.count() == 300 * 50


def carry_out(old, blocks):
    out, at = [], 0
    for b in sorted(blocks, key=lambda b: (b["at"], b["seg"])):
        assert b["at"] >= at and old[b["at"] : b["at"] + len(b["removed"])] == b["removed"] and (b["removed"] or b["added"])
        assert b["tag"] == ("insert" if not b["removed"] else "delete" if not b["added"] else "replace")
        out += old[at : b["at"]] + b["added"]
        at = b["at"] + len(b["removed"])
    return out + old[at:]


def test_patience_blocks_rebuild_the_new_text(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        old = [rng.choice(["a", "b", "", f"line {rng.randrange(9)}", f"own {k}.{i}"]) for i in range(rng.randrange(25))]
        new = [x for x in old if rng.random() < 0.8]
        for _ in range(rng.randrange(5)):
            new.insert(rng.randrange(len(new) + 1), rng.choice(["a", "new", "", "line 3"]))
        if k % 7 == 0:
            new = new[::-1]
        rows.append((k, old, new))
    rows += [(100, [], []), (101, None, ["x"]), (102, ["x"], None), (103, ["same"] * 5, ["same"] * 5), (104, ["x", "x"], ["x", "x", "x"])]
    df = spark.createDataFrame(rows, "k int, old array<string>, new array<string>")
    found = patience.blocks(df, "k", "old", "new", F.col("p"))
    by: dict = {}
    for b in found.collect():
        by.setdefault(b["k"], []).append(b)
    for k, old, new in rows:
        assert carry_out(old or [], by.get(k, [])) == (new or []), k
    assert 103 not in by and sum(len(b["added"]) for b in by[104]) == 1
    assert {r["k"]: r["new"] for r in patience.rebuilt(df, found, "k", "old").collect()} == {k: new or [] for k, _, new in rows}
    # a moved unique line costs one deletion and one insertion, not the text between
    df = spark.createDataFrame([(1, list("abcdefgh"), list("bcdefgha"))], "k int, old array<string>, new array<string>")
    assert sorted((b["tag"], b["removed"], b["added"]) for b in patience.blocks(df, "k", "old", "new", F.col("p")).collect()) == [("delete", ["a"], []), ("insert", [], ["a"])]


def test_keys_whose_pairs_all_ascend_need_no_call_of_python(spark, monkeypatch):
    longest = patience.chain

    def crossed_only(i, j):
        assert any(y <= x for x, y in zip(j.tolist(), j.tolist()[1:])), "these pairs ascend"
        return longest(i, j)

    monkeypatch.setattr(patience, "chain", crossed_only)
    pairs = [(1, 0, 0), (1, 2, 1), (1, 2, 1), (1, 3, 9), (2, 0, 5), (2, 1, 1), (2, 2, 2), (3, 4, 1), (3, 4, 2), (3, 5, 2), (4, 7, 7)]
    got = patience._chains(spark.createDataFrame(pairs, "key int, i int, j int"))
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0), (1, 2, 1), (1, 3, 9), (2, 1, 1), (2, 2, 2), (3, 4, 1), (3, 5, 2), (4, 7, 7)]


def test_stretches_are_those_of_the_blocks(spark):
    rng = random.Random(9)
    rows = [(k, [rng.choice("abcdefgh") for _ in range(rng.randrange(20))], [rng.choice("abcdefgh") for _ in range(rng.randrange(20))]) for k in range(40)]
    df = spark.createDataFrame([*rows, (100, None, ["x"]), (101, ["x"], None), (102, ["x"], ["x"])], "k int, old array<string>, new array<string>")
    told = lambda d: sorted((r.k, r.seg) for r in d.collect())
    assert told(patience.stretches(df, "k", "old", "new")) == told(patience.blocks(df, "k", "old", "new"))


def test_longest_chain():
    import numpy as np

    rng = random.Random(2)
    for _ in range(50):
        pairs = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(1, 14))}, key=lambda p: (p[0], -p[1]))
        keep = patience.chain(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        got = [p for p, k in zip(pairs, keep) if k]
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        best = [1] * len(pairs)
        for y in range(len(pairs)):
            for x in range(y):
                if pairs[x][0] < pairs[y][0] and pairs[x][1] < pairs[y][1]:
                    best[y] = max(best[y], best[x] + 1)
        assert len(got) == max(best)

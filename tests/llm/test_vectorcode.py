import hashlib
import math
import random
from collections import defaultdict

import numpy as np

from veriloom.llm import vectorcode


def brute(rows, scale=4096, parts=8, entries=16, rounds=6):
    """By plain loops over Python's integers; rows (id, vector, label)."""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    w = width // parts
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in start] for p in range(parts)]
    dist = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda x, book: min(range(len(book)), key=lambda j: (dist(x, book[j]), j))
    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for _, v, _ in kept:
                mine[near(cut(v, p), books[p])].append(cut(v, p))
            books[p] = [[sum(c) // len(mine[j]) for c in zip(*mine[j])] if j in mine else b for j, b in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for book in books for b in book for x in b).encode()).hexdigest()
    out, by = [], defaultdict(int)
    for i, v, lab in kept:
        at = [near(cut(v, p), books[p]) for p in range(parts)]
        e = sum(dist(cut(v, p), books[p][at[p]]) for p in range(parts))
        by[lab] += e
        out.append((i, "".join(f"{j:02x}" for j in at), e, lab))
    most = (1 << 63) - 1
    by = defaultdict(int)
    for _, _, e, lab in out:
        by[lab] += min(e, most)
    return sorted(((i, c, min(e, most), min(by[lab], most), sha) for i, c, e, lab in out), key=str)


def run(spark, rows, kind="float", **more):
    df = spark.createDataFrame([(i, v, lab, 0) for i, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int, error int").repartition(3)
    return sorted((tuple(r) for r in vectorcode.compress(df, **more).collect()), key=str)


def test_equals_plain_loops(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice((0.5, -0.25, rng.randrange(-8192, 8192) / 4096)) for _ in range(24)], rng.choice((1, 2, None))) for i in range(200)]
    rows += [(i, rows[i % 3][1], 1) for i in range(200, 260)] + [(300, None, 1), (301, [None] * 24, 1), (302, [math.nan] * 24, 2), (303, [math.inf] * 24, 2)]
    rows += [(None, [0.25] * 24, None), (5, [0.5] * 24, 7), (400, [0.125] * 13, 7), (401, [], 7)]
    assert run(spark, rows) == brute(rows)


def test_ties_few_rows_and_empty(spark):
    assert run(spark, []) == []
    few = [(3, [1.0, -1.0], 1), (1, [0.0, 0.0], None)]
    assert run(spark, few) == brute(few)
    flat = [(i, [0.5] * 8, 0) for i in range(40)]
    got = run(spark, flat)
    assert got == brute(flat) and {r[1] for r in got} == {"00" * 8}


def test_components_beyond_int64(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((1e30, -3e25, 1e8, 0.5)) * rng.random() for _ in range(8)], i % 2) for i in range(40)]
    assert run(spark, rows, "double") == brute(rows)
    rows = [(i, [rng.randrange(-(1 << 40), 1 << 40) / 4096 for _ in range(16)], i % 2) for i in range(60)]
    assert run(spark, rows, "double") == brute(rows)


def test_intervals_hold_and_screening_decides_most():
    rng = np.random.default_rng(3)
    for size in (50, 3000, 1 << 18, 1 << 24):
        x, c = rng.integers(-size, size, (500, 8)), rng.integers(-size, size, (16, 8))
        c[9] = c[2]
        c[10] = c[3] + (np.arange(8) == 0)
        low, high = vectorcode.intervals(x, c)
        exact = (c.astype(object) ** 2).sum(1) - 2 * (x.astype(object) @ c.T.astype(object))
        assert (low <= exact).all() and (exact <= high).all()
        met = vectorcode.Met()
        at, d = vectorcode.nearest(x, c, met)
        full = ((x.astype(object)[:, None] - c[None]) ** 2).sum(2)
        assert at.tolist() == [int(min(range(16), key=lambda j: (r[j], j))) for r in full] and d.tolist() == full[np.arange(500), at].tolist()
        assert met.parts == 500 and 0 < met.again < 500 * 4  # not all 16 entries of a part


def test_sums_carry_over_limbs():
    for v in (0, 1, -1, (1 << 32) - 1, -(1 << 32), 12345678901234567890, -(1 << 90) + 7):
        limbs = vectorcode._limbs(v, 4)
        assert sum(x << 32 * i for i, x in enumerate(limbs)) == v and all(0 <= x < 1 << 32 for x in limbs[:-1])

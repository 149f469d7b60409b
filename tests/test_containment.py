import random

from veriloom.operators import gramindex, spread

PLAIN = {"’": "'", "ﬁ": "fi"}


def norm(x):
    for k, v in PLAIN.items():
        x = x.replace(k, v)
    out, gap = "", False
    for ch in x:
        if ch in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85   ":
            gap = True
            continue
        out += (" " if gap else "") + ch
        gap = False
    return out + (" " if gap else "")


def brute(claims, texts):
    out = []
    for i, c in claims:
        hits = [j for j, x in texts if c is not None and x is not None and norm(c) in norm(x)]
        out.append((i, len(hits), min(hits) if hits else None))
    return sorted(out, key=str)


def run(spark, claims, texts, most=None):
    c = spark.createDataFrame([(i, x, 0) for i, x in claims], "id long, claim string, n int")
    t = spark.createDataFrame([(i, x, 0) for i, x in texts], "id long, body string, h int")
    return sorted((tuple(r) for r in gramindex.support(c, t, "id", "claim", "id", "body", most).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "a", "court", "filing", "ﬁling", "don’t", "don't", "été", "x"] + [f"w{i}" for i in range(25)]
    texts = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", " "]) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    texts += [(100 + i, texts[i % 7][1]) for i in range(20)] + [(200, None), (201, ""), (202, "  "), (203, "the")]
    claims = []
    for i in range(90):
        j, x = texts[rng.randrange(60)]
        a = rng.randrange(len(x))
        claims.append((i, x[a : a + rng.choice([1, 2, 3, 5, 9, 20, 60])]))  # from anywhere, also inside words
    claims += [(500, None), (501, ""), (502, " "), (503, "nowhere at all here"), (504, "the"), (504, "the"), (505, "q"), (506, "the of zz a court")]
    return claims + [(1000 + j, x) for j, x in texts], texts


def test_equals_plain_containment(spark):
    claims, texts = corpus(3)
    want = brute(claims, texts)
    assert run(spark, claims, texts) == want
    # every key of more than two rows is dealt to cells
    assert run(spark, claims, texts, (2, 3)) == want
    assert run(spark, [], texts) == [] and run(spark, claims[:5], []) == brute(claims[:5], [])


def test_nothing_of_claims_or_texts_is_broadcast(spark):
    claims, texts = corpus(4)
    c, t = (spark.createDataFrame(rows, "id long, x string") for rows in (claims, texts))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gramindex.support(c, t, "id", "x", "id", "x")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_hot_keys_meet_in_cells(spark):
    left = spark.createDataFrame([(k, i) for i in range(300) for k in ("hot" if i % 3 else f"k{i}",)] + [(None, 1)], "k string, a long")
    right = spark.createDataFrame([("hot", j) for j in range(40)] + [(f"k{j}", j) for j in range(300)], "k string, b long")
    got = spread.block_join(left, right, "k", "a", "b", (20, 7))
    want = sorted((r["k"], r["a"], r["b"]) for r in left.join(right, "k").collect())
    assert sorted((r["k"], r["a"], r["b"]) for r in got.collect()) == want
    sizes = got.groupBy("k", "a").count().where("k = 'hot'").agg({"count": "max"}).first()[0]
    assert sizes == 40


def test_limits_bound_the_hot_keys():
    for rows in (0, 10, 8_192_000, 10**13):
        assert rows / spread.limit(rows) <= spread.HOT_KEYS


def test_tables_grow_with_the_texts_not_with_their_grams(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    texts = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(600))) for i in range(300)]
    made = []
    monkeypatch.setattr(gramindex, "scratch", lambda _, name: made.append(name) or f"file://{tmp_path}/{len(made)}-{name}")
    assert run(spark, texts, texts) == sorted(((i, 1, i) for i, _ in texts), key=str)
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 1.5 * sum(len(x) for _, x in texts)


def test_tables_hold_no_texts(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    texts = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(600))) for i in range(300)]
    texts += [(1000 + i, x) for i, x in texts[:100]] * 2
    rows = {}
    kept = gramindex._kept

    def counted(df, name):
        out = kept(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(gramindex, "scratch", lambda _, name: f"file://{tmp_path}/{len(rows)}-{name}")
    monkeypatch.setattr(gramindex, "_kept", counted)
    monkeypatch.setattr(gramindex, "_forget", lambda *tables: None)
    want = [((i, 3 if i % 1000 < 100 else 1, i % 1000)) for i, _ in texts]
    assert run(spark, texts, texts) == sorted(want, key=str)
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 0.3 * sum(len(x) for _, x in texts)
    assert rows["keyed"] == 300 and rows["index"] < 600  # copies beside the first are not taken apart, but for those that a bitmap lets through

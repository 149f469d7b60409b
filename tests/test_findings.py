"""Registered queries on small tables that showed a difference or a growth, against their SQL."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as e


@pytest.fixture
def agree(spark, tmp_path):
    """Whether a query and its SQL have the same rows over tables of (schema, rows) by name; the rows."""

    def go(name, **tables):
        c = duckdb.connect()
        for t, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
            c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
        got = e.queries()[name](spark, str(tmp_path))
        cols = sorted(got.columns)
        have = sorted(map(str, (tuple(r) for r in got.select(*cols).collect())))
        want = sorted(map(str, c.execute(f"select {', '.join(cols)} from ({e.oracle_sql()[name]})").fetchall()))
        assert have == want
        return have

    return go


def test_files_of_short_texts_are_broken_too(agree):
    got = agree("docx_parts", documents=("doc_id long, text string", [(9, "a"), (19, ""), (29, "longer " * 90), (1, "a\n\nb"), (2, "")]))
    assert sum("True" in r for r in got) == 3


def test_purchases_at_parts_of_a_second(agree):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(1, at(0.2), 1, "view"), (2, at(86399.7), 1, "purchase"), (3, at(0.7), 2, "view"), (4, at(0.6), 2, "purchase"), (5, at(0.4), 2, "purchase"), (6, at(9.5), 3, "view"), (7, at(10.5), 3, "purchase"), (8, at(10.2), 3, "purchase")]
    agree("next_purchase", events=("event_id long, ts timestamp_ntz, user_id long, event_type string", rows))


def test_recipes_of_more_than_a_hundred_sources(agree):
    rows = [(k, 3 if k < 170 else 5, f"Customer {k}", float(k % 4 - 1)) for k in range(1, 180)]
    agree("recipe_files", customer=("c_custkey long, c_nationkey int, c_name string, c_acctbal double", rows))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_addresses_meet_evidence_where_their_numbers_stand(spark):
    from pyspark.sql import functions as F

    from veriloom.functions import claims as C
    from veriloom.operators import fidelity

    said = ["12 Main Hill Street", "112 Main Hill Street", "12 Main Hill Way", "P.O. Box 1234567", "P.O. Box 12345678", "9 Elm St"]
    held = ["at 12MAIN  Hill street", "x112MainHillWay p.o.box12345678", "2 MainHillStreet", "no numbers", "9elmst", None, "12 main hill streetx 5", "12MainHillStreet, 212mainhill way"]
    pages = spark.createDataFrame([(k, f"Write to {a}.") for k in range(len(held)) for a in said] + [(None, said[0])], "slug int, raw string")
    ev = spark.createDataFrame(list(enumerate(held)), "slug int, body string")
    got = fidelity.missing_addresses(pages, ev)
    claimed = fidelity.explode_values(pages, "slug", C.addresses("raw")).distinct()
    known = fidelity.explode_values(ev, "slug", C.addresses("body")).distinct()
    e = ev.select(F.col("slug").alias("k"), "body")
    want = claimed.join(known, ["slug", "value"], "left_anti").join(e, (F.col("slug") == F.col("k")) & C.address_in("value", "body"), "left_anti")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 20
    assert not any("LeftAnti" in x and "RLIKE" in x.upper() for x in plan(got).splitlines())  # no anti join tries a key's texts one by one


def test_shortest_unique_prefix_takes_few_searches(spark):
    import random

    from pyspark.sql import functions as F

    from veriloom.functions import text as T

    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(60))) * rng.randrange(1, 4) for _ in range(200)] + ["", "a" * 40, "é𝄞" * 20]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", T.shortest_unique("x", F.lit(3), 4, 30).alias("got"))
    for r in df.collect():
        x = texts[r.i]
        tries = [x[3 : 3 + n] for n in range(4, 31)]
        assert r.got == next((p for p in tries if len(p) >= 4 and x.count(p) == 1), None), x
    assert "sequence(4, 30" not in str(T.shortest_unique("x", F.lit(3), 4, 30))  # the lengths, tried one by one


def test_small_ranges_are_dealt_to_few_tasks(spark, tmp_path):
    from veriloom.sources import capture_log

    for k in range(3):
        (tmp_path / f"k{k}").mkdir()
        (tmp_path / f"k{k}" / "a.txt").write_text("".join(f"{k} line {i}\n" for i in range(5000 * k)))
    folder = capture_log.Folder({"path": str(tmp_path), "glob": "*.txt", "range": "50"})
    assert 2 < len(capture_log.CaptureReader(folder).partitions()) <= capture_log.TASKS + 1
    got = capture_log.captures(spark, str(tmp_path), glob="*.txt", range="50")
    assert sorted(r.text for r in got.collect()) == sorted(f"{k} line {i}" for k in range(3) for i in range(5000 * k))


def test_batches_of_long_texts_end_by_bytes(spark):
    from pyspark.sql import functions as F

    from veriloom.session import ship

    ship(spark)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    got = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("x")).mapInArrow(sizes, "n long").collect()
    assert max(r.n for r in got) <= 6 << 20


def test_names_are_dealt_by_slug_before_they_are_gathered(spark):
    from veriloom.operators import history

    old = spark.createDataFrame([(k, "main", "h", [], "drift", i, f"2026-01-02{x}.txt") for k in range(9) for i, x in enumerate(["", "-b", "-c"][: k % 4])], "slug int, kind string, hash string, headers array<string>, result string, seq int, capture string")
    new = spark.createDataFrame([(k, "main", "2026-01-02", "drift", "h", []) for k in range(9)], "slug int, kind string, date string, result string, hash string, headers array<string>")
    got = history.retain(new, old)
    assert {r.slug: r.capture for r in got.collect()} == {k: f"2026-01-02{['', '-b', '-c', '-d'][k % 4]}.txt" for k in range(9)}
    assert "REPARTITION_BY_COL" in plan(got)


def test_a_side_goes_over_the_network_once_a_round(spark):
    from veriloom.operators import patience

    side = spark.createDataFrame([(k, i, f"h{i}") for k in range(2) for i in range(6)], "key int, at int, h string")
    m = spark.createDataFrame([(0, 1, 0), (0, 3, 2), (1, 0, 0)], "key int, i int, j int")
    left = patience._left(side, m, "i")
    assert sorted((r.key, r.at, r.seg) for r in left.collect()) == [(0, 0, 0), (0, 2, 1), (0, 4, 2), (0, 5, 2), (1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 4, 1), (1, 5, 1)]
    text = plan(left.groupBy("key", "seg", "h").count())
    text = text[text.rindex("Initial Plan") :] if "Initial Plan" in text else text
    assert text.count("Exchange hashpartitioning") == 1


def test_keys_of_a_window_do_not_stand_in_a_row(agree, spark, tmp_path):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a small table's texts would be broadcast
    try:
        agree(
            "commits_in_window",
            orders=("o_custkey long, o_orderdate timestamp_ntz", [(k, day(k * 7919 % 12)) for k in range(600)]),
            lineitem=("l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz", [(k, 1, day(k % 60)) for k in range(300)]),
        )
        parts = e.queries()["commits_in_window"](spark, str(tmp_path)).rdd.glom().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    texts = [[r.within for r in p] for p in parts if p]
    same = sum(a == b for p in texts for a, b in zip(p, p[1:]))
    assert max(len(set(p)) for p in texts) > 3 and same < 300  # sorted by text, all but twelve of 600


def test_windows_are_dealt_by_bytes_and_long_rows_end_row_groups(spark, tmp_path, monkeypatch):
    import random

    import pyarrow.parquet as pq

    from veriloom.plans import queries as Q

    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    spark.createDataFrame([(k, day(k % 40)) for k in range(80)], "o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 1, day(k % 60)) for k in range(3000)], "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(Q, "WINDOW_BYTES", 20_000, raising=False)  # a window has some 10,000
    got = e.queries()["commits_in_window"](spark, str(tmp_path))
    parts = [{r.within for r in p} for p in got.rdd.glom().collect()]
    assert sum(map(len, parts)) == 40 and max(map(len, parts)) < 10  # no task holds the texts of all windows
    # The result's writer looks at a row group's size before it holds a hundred long rows.
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, rng.randbytes(20_000).hex()) for i in range(120)], "id long, within string").coalesce(1)
    rows.write.option("parquet.block.size", 1 << 20).parquet(f"{tmp_path}/long")
    (file,) = (tmp_path / "long").glob("*.parquet")
    m = pq.ParquetFile(file).metadata
    assert max(m.row_group(i).num_rows for i in range(m.num_row_groups)) < 60

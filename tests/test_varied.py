"""Queries over varied inputs against their SQL, and that a broken operator shows in each."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from veriloom.functions import claims as C
from veriloom.operators import coverage, fidelity, health, queue, worker
from veriloom.sources import sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def agree(spark, sql, name):
    got = e.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = sql.execute(f"select {', '.join(cols)} from ({e.oracle_sql()[name]})").fetchall()
    return sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want))


REAL = {"host": C.host, "address_in": C.address_in}
#: Of each query an operator, and a broken one in its place.
BROKEN = {
    "hosts_of_pages": (C, "host", lambda c: REAL["host"](F.regexp_replace(c, r"://[^.]+\.", "://"))),
    "addresses_of_customers": (C, "address_in", lambda a, b, least=12: REAL["address_in"](a, b, least) & F.lit(False)),
    "packet_files": (health, "packet_set", lambda p, lang="en": p.select(F.lit("a").alias("slug"), F.lit("main").alias("kind"), "path")),
    "rotation_of_customers": (health, "archival", lambda c: F.lit(False)),
    "check_totals": (coverage, "soft_or_hard", lambda bad, free, key: bad.withColumn("soft", F.lit(True))),
    "index_of_turns": (fidelity, "quote_index", lambda t, column="value": t.where("trim(value) <> ''").select(F.from_json("value", "id string, state string, in_scope boolean, text string").alias("r")).select("r.*")),
    "redirects_of_pages": (coverage, "canonical_path", lambda p: F.concat(F.lit("/"), p)),
    "archive_plan": (queue, "REST_DAYS", 0),
    "archive_run": (worker, "HARD", ("http-403",)),
    "archive_confirm": (worker, "THROTTLED", "never"),
    "archive_record": (sinks, "range_text", lambda d, today: F.lit("this date")),
}


@pytest.mark.parametrize("name", BROKEN)
def test_equal_and_red_when_broken(spark, sql, monkeypatch, name):
    assert agree(spark, sql, name)
    monkeypatch.setattr(*BROKEN[name])
    assert not agree(spark, sql, name)

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from veriloom.operators import health, history
from veriloom.sources import sinks
from veriloom.sources.files import SOURCE


def one(spark, f, **cols):
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols)).select(f(*[F.col(c) for c in cols])).first()[0]


def test_manifest_rows_and_ledger(spark, tmp_path):
    df = spark.createDataFrame([("a", "2026-01-01", "drift", None), ("b", "2026-01-02", "confirmed", "h")], "slug string, date string, result string, hash string")
    sinks.append_rows(df, f"{tmp_path}/m")
    sinks.append_rows(df.where("slug = 'a'"), f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").groupBy("slug").count().orderBy("slug").collect() == [("a", 2), ("b", 1)]
    led = spark.createDataFrame([("http://b", 2), ('http://a"x', 1)], "url string, attempts int")
    assert json.loads(sinks.ledger_json(led).first().json) == {"sources": {'http://a"x': {"attempts": 1}, "http://b": {"attempts": 2}}}
    sinks.overwrite_current(df, f"{tmp_path}/c")
    sinks.overwrite_current(df.limit(1), f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 1


def test_anchor_entries_chain(spark):
    files = spark.createDataFrame([("b", bytearray(b"2")), ("a", bytearray(b"1"))], "path string, content binary")
    first = sinks.anchor_entry(files, None, "r1", "u", "repo", ["a", "b"]).first()
    assert first.manifest.splitlines() == [f"{hashlib.sha256(c).hexdigest()}  {p}" for p, c in (("a", b"1"), ("b", b"2"))]
    e = json.loads(first.entry)
    assert e["prev_entry_sha256"] is None and e["file_count"] == 2 and e["manifest_sha256"] == hashlib.sha256(first.manifest.encode()).hexdigest()
    assert first.entry_sha256 == hashlib.sha256(json.dumps(e, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    second = sinks.anchor_entry(files, first.entry_sha256, "r2", "u", "repo", ["a"], "why").first()
    rows = [(i, x.entry_sha256, json.loads(x.entry)["prev_entry_sha256"]) for i, x in enumerate((first, second))]
    assert history.chain_breaks(spark.createDataFrame(rows, "id int, entry_sha256 string, prev_entry_sha256 string")).count() == 0


def test_page_edits(spark):
    page = "x<!-- P:BEGIN -->old<!-- P:END -->y"
    assert one(spark, lambda p: sinks.inject(p, "P", F.lit("new")), p=page) == "x<!-- P:BEGIN -->\nnew\n<!-- P:END -->y"
    with pytest.raises(Exception, match="no markers"):
        one(spark, lambda p: sinks.inject(p, "Q", F.lit("new")), p=page)
    assert one(spark, lambda p: sinks.insert_after(p, "## Log\n", F.lit("e")), p="a\n## Log\nb") == "a\n## Log\ne\n\nb"
    assert one(spark, lambda p: sinks.insert_after(p, "## Log\n", F.lit("e")), p="## Log\n## Log\n") is None
    lines = [r.line for r in sinks.redirects(spark.createDataFrame([("states/ohio.html",), ("index.html",)], "path string")).collect()]
    assert lines == ["/index.html / 301", "/states/ohio /states/ohio/ 301", "/states/ohio.html /states/ohio/ 301"]


def test_checked_dates_and_corrections(spark):
    pages = spark.createDataFrame([("ohio", "**Sources last checked.** 2026-02-03", '<dd class="docket-checked">Feb 3, 2026</dd>'), ("texas", "**Sources last checked.** soon", "")], "slug string, md string, html string")
    index = spark.createDataFrame([('<tr><td><a href="/states/ohio/">Ohio</a></td><td>Jan 1, 2026</td></tr>',)], "html string")
    home = spark.createDataFrame([('<script type="application/json" id="state-index">[{"slug":"ohio","checked":"Feb 3, 2026"}]</script>',)], "html string")
    got = sinks.checked_dates(pages, index, home)
    assert sorted((r.surface, r.slug, r.checked) for r in got.collect()) == [("json", "ohio", "Feb 3, 2026"), ("page", "ohio", "Feb 3, 2026"), ("source", "ohio", "Feb 3, 2026"), ("source", "texas", "soon"), ("table", "ohio", "Jan 1, 2026")]
    told = got.where("surface = 'source'")
    assert [tuple(r) for r in sinks.corrections(told, got.where("surface <> 'source'")).collect()] == [("table", "ohio", "Jan 1, 2026", "Feb 3, 2026")]


def test_links_and_names(spark):
    page = '<a href="https://a.org/x">a.org/x</a> <a href="https://a.org/x">The <b>notice</b></a> <a href="https://b.org/">b.org page</a> <a href="https://web.archive.org/web/2026/https://b.org/">c</a>'
    df = spark.createDataFrame([("s", page)], "slug string, html string")
    assert [(r.slug, r.url) for r in sinks.needed_links(df).collect()] == [("s", "https://a.org/x")]
    name = lambda u: one(spark, lambda p: sinks.source_name(p, F.lit(u)), p=page)
    assert [name(u) for u in ("https://a.org/x", "https://b.org/", "https://www.c.org/z")] == ["The notice", "b.org page", "c.org/z"]
    spec = spark.createDataFrame([(("A", "B", 2, None),), (("A", None, None, None),)], "s struct<`from`:string,`to`:string,from_occurrence:int,to_occurrence:int>")
    assert [r[0] for r in spec.select(sinks.slice_note(F.col("s"))).collect()] == ["slice from 'A' (occurrence 2) to 'B'", "slice from 'A' to the end of the document"]
    d = spark.createDataFrame([(["2026-01-02"],), (["2026-01-01"],), (["2026-01-03", "2026-01-01"],)], "d array<string>")
    assert [r[0] for r in d.select(sinks.range_text(F.col("d"), F.lit("2026-01-02"))).collect()] == ["this date", "on 2026-01-01", "between 2026-01-01 and 2026-01-03"]


def test_report_digest_and_transport(spark):
    f = spark.createDataFrame([("ohio", "text changed")], "slug string, verdict string")
    a = spark.createDataFrame([("drift", 1), ("confirmed", 4)], "result string, passes long")
    assert json.loads(sinks.report(f, a, "2026-01-01", "2026-01-31").first().json) == {"window": {"from": "2026-01-01", "to": "2026-01-31"}, "attendance": {"confirmed": 4, "drift": 1}, "passes": 5, "findings": [{"slug": "ohio", "verdict": "text changed"}]}
    base = {"sources": [{"n": 1, "title": "t", "url": "u", "transport": "curl", "extractor": "docx"}]}
    change = lambda **k: json.dumps({"sources": [base["sources"][0] | k]})
    texts = [json.dumps(base), change(title="other", notes="x", user_agent="none", compressed=True), change(scope="main"), change(compressed=False), change(user_agent="x"), None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "r string").select(sinks.method_digest(F.col("r"))).collect()]
    assert got[0] == got[1] and len(set(got)) == 5 and got[5] is None and len(got[0]) == 12
    h, k = "0123456789ab", "ba9876543210"
    rows = [(h, None), (h, "curl"), (h, f"curl, recipe {h}"), (h, f"recipe {k}"), (None, "by recipe"), (None, "curl"), (None, None)]
    got = [(r[0].transport, r[0].error is not None) for r in spark.createDataFrame(rows, "d string, g string").select(sinks.transport(F.col("d"), F.col("g"))).collect()]
    assert got == [(f"recipe {h}", False), (f"curl, recipe {h}", False), (f"curl, recipe {h}", False), (None, True), (None, True), ("curl", False), (None, False)]
    assert "n int" in SOURCE


def test_packet_sets_and_health(spark):
    files = spark.createDataFrame([(f"/p/{x}.txt",) for x in ("ohio-packet-law", "ohio-packet", "ohio-packet-es", "new-york-packet", "TEMPLATE-packet", "readme")], "path string")
    assert [(r.slug, r.kind) for r in health.packet_set(files).collect()] == [("new-york", "main"), ("ohio", "main"), ("ohio", "law")]
    assert [(r.slug, r.kind) for r in health.packet_set(files, "es").collect()] == [("ohio", "es")]
    rev = spark.createDataFrame([("ohio", "/p/ohio-packet.txt"), ("ohio", "/p/review/ohio-packet-law.txt"), ("ohio", "/p/review/ohio-2026.txt")], "slug string, path string")
    assert [r.error for r in health.review_errors(rev, "/p").collect()] == ["a standing packet", "a supplement"]
    today = F.lit("2026-06-30").cast("date")
    latest = spark.createDataFrame([("a", "2026-06-29"), ("b", "2026-05-01")], "slug string, date string")
    slugs = latest.select("slug")
    supp = spark.createDataFrame([("x", "a-law", "ASSEMBLED: 2026-01-01"), ("y", "b-law", "CLASS: archival\nASSEMBLED: 2020-01-01"), ("z", "c-law", "ASSEMBLY DATE 2026-06-01")], "path string, stem string, head string")
    rec = spark.createDataFrame([("a-law",)], "stem string")
    led = spark.createDataFrame([("u", "submit-401", "FAILED"), ("v", "submit-401", "SKIPPED")], "url string, last_detail string, last_result string")
    said = lambda *x: sorted(tuple(r) for r in health.report(*x).collect())
    got = said(latest, today, slugs, "zz", True, supp, rec, led, ["submit-401"])
    assert got == [
        ("note", "1 not reviewed within a lap, oldest at 2026-05-01"), ("note", "no recipe for c-law"), ("note", "old supplement a-law"),
        ("severe", "1 sources rest on an account fault"), ("severe", "the cursor names 'zz', which is not in the rotation"), ("severe", "undeclared account faults: playback-429"),
    ]
    fine = (slugs, "a", True, supp.limit(0), rec, led.limit(0), list(health.ACCOUNT_FAULTS))
    assert health.healthy(health.report(latest.limit(1), today, *fine)) and not health.healthy(health.report(latest.limit(0), today, *fine))
    assert ("severe", "no pass recorded for 33 days") in said(latest.limit(1), F.lit("2026-08-01").cast("date"), *fine)
    assert ("severe", "the cursor is lost") in said(latest, today, slugs, None, True, *fine[3:]) and ("note", "the rotation has not started") in said(latest, today, slugs, None, False, *fine[3:])

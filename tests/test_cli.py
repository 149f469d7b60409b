"""The commands over small folders, and their exit codes."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from veriloom.cli import main
from veriloom.sources import extract, files, packets


@pytest.fixture
def run(spark):
    def go(*args):
        said = []
        return main([str(a) for a in args], spark, said.append), said

    return go


def tree(root, **texts):
    for name, text in texts.items():
        path = root / name.replace("__", "/").replace("_DOT_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


PACKET = "Notes\nSTATE: ohio\nASSEMBLED: 2026-01-01\nSOURCE 1: t | https://x.org/a | source date: May | retrieved: 2026-01-01\nThe rule says to file within ten days.\nEND SOURCE 1\n"


def test_fidelity_and_check_all(run, tmp_path):
    tree(tmp_path, **{"pages__ohio_DOT_html": '<p>It says "to file within ten days" here.</p>', "pages__utah_DOT_md": 'It says "something that no packet holds".', "packets__ohio-packet_DOT_txt": PACKET, "packets__utah-packet_DOT_txt": PACKET})
    code, said = run("fidelity", tmp_path / "pages", tmp_path / "packets")
    assert code == 1 and said == ["utah  QUOTE  something that no packet holds"]
    code, said = run("check-all", tmp_path / "pages", tmp_path / "packets", "--quiet")
    assert code == 1 and said == ["2 page(s): 1 clean, 0 soft, 1 hard"]
    assert run("check-all", tmp_path / "pages", tmp_path / "packets", "--quiet", "--exempt", "utah") == (0, ["2 page(s): 1 clean, 1 soft, 0 hard"])
    assert run("check-all", tmp_path / "pages", tmp_path / "packets", "--quiet", "--strict", "--exempt", "utah")[0] == 1
    assert run("packet-set", tmp_path / "packets")[0] == 0 and run("packet-set", tmp_path / "packets", "--lang", "es")[0] == 1
    assert run("fidelity", tmp_path / "absent", tmp_path / "packets")[0] == 2 and run("no-such-command")[0] == 2


def test_lint_looks_at_options(run, spark, tmp_path):
    good = {"n": 1, "title": "t", "url": "https://x.org", "transport": "curl", "extractor": "docx", "scope": "paragraphs-only"}
    tree(tmp_path, ohio_DOT_json=json.dumps({"recipe_version": 1, "state": "ohio", "sources": [good]}))
    assert run("lint", tmp_path / "ohio.json") == (0, [])
    bad = {"n": 2, "title": "t", "urls": ["https://x.org"], "transport": "chrome", "extractor": "pdfplumber", "scope": "main", "encoding": "utf-7", "drop_sr_only": True, "slice": {"from": "short", "to_occurrence": 2}}
    tree(tmp_path, utah_DOT_json=json.dumps({"recipe_version": 2, "state": "Utah", "sources": [bad]}))
    said = {e for _, _, e in (tuple(r) for r in files.lint(files.recipes(spark, str(tmp_path / "utah.json")), options=True).collect())}
    assert said == {
        "unknown recipe_version", "the file is not named after the state", "sources are not numbered in order", "urls takes two pages or more", "urls is for curl only", "encoding is for curl only",
        "unknown encoding", "encoding is for texts only", "a scope means nothing here", "drop_sr_only is for html-text only", "the from anchor is too short", "to_occurrence without to",
    }
    assert run("lint", tmp_path / "utah.json")[0] == 1


def test_history_commands(run, spark, tmp_path):
    new = PACKET.replace("ten days", "ninety days and no longer")
    tree(tmp_path, **{"h__ohio__2026-01-01_DOT_txt": PACKET, "h__ohio__2026-02-01_DOT_txt": new})
    hashes = [spark.createDataFrame([(t,)], "t string").select(packets.packet_hash("t")).first()[0] for t in (PACKET, new)]
    rows = [
        {"date": "2026-01-01", "result": "baseline", "hash": hashes[0], "capture": "2026-01-01.txt", "stored": True, "kind": "main"},
        {"date": "2026-02-01", "result": "drift", "hash": hashes[1], "capture": "2026-02-01.txt", "stored": True, "kind": "main", "supersedes": "2026-01-01.txt"},
    ]
    tree(tmp_path, h__ohio__manifest_DOT_jsonl="\n".join(map(json.dumps, rows)))
    assert run("retain", tmp_path / "h") == (0, [])
    code, said = run("digest", tmp_path / "h", "2026-02-01", "2026-02-28")
    assert code == 0 and said == ["Changes from 2026-02-01 to 2026-02-28\n1 pass(es): drift 1\n\nCandidates (1)\n  2026-02-01  ohio (main)  2026-01-01.txt -> 2026-02-01.txt\n    text changed\n\nTooling, not news (0)\n  none\n"]
    assert "- **ohio** (2026-02-01) — text changed." in run("digest", tmp_path / "h", "2026-02-01", "2026-02-28", "--draft")[1][0]
    assert json.loads(run("digest", tmp_path / "h", "2026-02-01", "2026-02-28", "--json")[1][0])["passes"] == 1
    (tmp_path / "h/ohio/2026-01-01.txt").unlink()
    assert run("retain", tmp_path / "h") == (1, ["ohio  2026-01-01.txt  missing"])
    assert run("digest", tmp_path / "h", "2026-02-01", "2026-02-28")[0] == 1
    tree(tmp_path, **{"p__ohio-packet-forms_DOT_txt": PACKET, "r__other_DOT_json": "{}"})
    code, said = run("health", tmp_path / "h", tmp_path / "p", tmp_path / "r", "2026-02-02")
    assert code == 0 and "note  no recipe for ohio-packet-forms" in said
    assert run("health", tmp_path / "h", tmp_path / "p", tmp_path / "r", "2026-04-02")[0] == 1


def test_anchor_sitemap_and_status(run, tmp_path):
    tree(tmp_path, site__index_DOT_html='<time datetime="2026-01-05">', site__a__b_DOT_html="x", site__c_DOT_html='<meta name="robots" content="noindex">')
    names = ["index.html", "a/b.html", "c.html"]
    line = lambda n: f"{hashlib.sha256((tmp_path / 'site' / n).read_bytes()).hexdigest()}  {n}"
    tree(tmp_path, manifest_DOT_txt="\n".join([*map(line, names), "0" * 64 + "  gone.html"]) + "\n")
    assert run("anchor", tmp_path / "site", tmp_path / "manifest.txt") == (1, ["gone.html  missing"])
    code, said = run("sitemap", tmp_path / "site", "https://x.org", "2026-02-02")
    assert code == 0 and said[0].count("<loc>") == 2 and "<loc>https://x.org/</loc><lastmod>2026-01-05<" in said[0] and "https://x.org/a/b/" in said[0]
    tree(tmp_path, map_DOT_xml=said[0])
    assert run("sitemap", tmp_path / "site", "https://x.org", "2026-02-02", "--check", tmp_path / "map.xml")[0] == 0
    assert run("sitemap", tmp_path / "site", "https://x.org", "2026-02-03", "--check", tmp_path / "map.xml")[0] == 1
    tree(tmp_path, pages__ohio_DOT_html='<a href="https://s.org/1"> <a href="https://s.org/2">', ledger_DOT_json=json.dumps({"sources": {"https://s.org/1": {"last_result": "PENDING", "capture": "c", "last_attempt": "2026-02-01T00:00:00Z"}}}))
    assert run("status", tmp_path / "pages", tmp_path / "ledger.json", "2026-02-02 00:00:00") == (0, ["ohio  2  1  0  0  0  1"])


def test_each_extractor_is_reached(spark):
    src = "struct<extractor:string,scope:string,encoding:string,drop_icon_space:boolean,drop_sr_only:boolean,slice:struct<`from`:string,`to`:string,from_occurrence:int,to_occurrence:int>,filters:array<string>>"
    page = '<body><main><p>One<span class="sr-only"> hidden</span></p><p>Two   words</p></main><script id="__NEXT_DATA__" type="application/json">{"a": {"b": ["x", "y"]}}</script></body>'
    rows = [
        (1, ("html-text", "main", None, None, True, None, ["trim-lines"]), page.encode()), (2, ("next-data", '["a.b[1]", "a.b[0]"]', None, None, None, None, None), page.encode()),
        (3, ("json-doc", "k", None, None, None, None, None), b'{"k": {"v": 1, "w": ""}}'), (4, ("none", None, "cp1252", None, None, ("the start of", "the end of", 1, 2), ["normalize-apostrophes"]), "no the  start of it\x92s the end of a the end of b".encode("latin-1")),
        (5, ("none", None, None, None, None, None, []), "a\fb".encode()),
    ]
    got = {r.i: r.body for r in extract.extract(spark.createDataFrame(rows, f"i int, s {src}, content binary")).collect()}
    assert got[1].split() == ["One", "Two", "words"]
    assert got[2] == "y\n\nx" and got[3] == "v: 1" and got[4] == "the  start of it's the end of a " and got[5] == "a\nb"
    with pytest.raises(Exception, match="undecodable"):
        extract.extract(spark.createDataFrame([(1, ("none", None, None, None, None, None, None), b"\xff")], f"i int, s {src}, content binary")).collect()


def test_paths_dates_of_commits_and_totals(spark):
    lines = spark.createDataFrame([("a/b/ # note",), ("# all",), ("",), (" c.txt",)], "value string")
    assert [r.path for r in files.path_list(lines).collect()] == ["a/b", "c.txt"]
    log = spark.createDataFrame([("h1", "2026-01-02", "p"), ("h2", "2026-03-04", "p")], "hash string, date string, path string").withColumn("date", F.to_date("date"))
    assert [tuple(map(str, r)) for r in files.commit_dates(log).collect()] == [("p", "2026-01-02", "2026-03-04")]
    c = spark.createDataFrame([("p", "ASSEMBLED: 2025-05-05", None), ("p", "x", None), ("q", "x", "2026-07-08 10:00:00"), ("r", "x", None)], "path string, head string, modified string").withColumn("modified", F.to_timestamp("modified"))
    assert [(r.assembled, r.date_source) for r in files.assembly_dates(c, log).orderBy("path", "head").collect()] == [("2025-05-05", "header"), ("2026-01-02", "git"), ("2026-07-08", "mtime"), (None, None)]


def test_retaining_twice_writes_once(run, tmp_path):
    tree(tmp_path, **{"p__ohio-packet_DOT_txt": PACKET})
    at = (tmp_path / "p", tmp_path / "h")
    assert run("retain-result", *at, "baseline", "2026-01-01") == (0, ["ohio  main  2026-01-01.txt  stored", "1 recorded"])
    assert run("retain-result", *at, "baseline", "2026-01-01") == (0, ["0 recorded"])
    assert run("retain", tmp_path / "h") == (0, [])
    assert run("retain-result", *at, "confirmed", "2026-02-01") == (0, ["ohio  main  2026-01-01.txt  unchanged", "1 recorded"])
    (tmp_path / "p/ohio-packet.txt").write_text(PACKET + "more words\n")
    assert run("retain-result", *at, "drift", "2026-02-01")[1][0] == "ohio  main  2026-02-01.txt  stored"
    rows = [json.loads(x) for x in (tmp_path / "h/ohio/manifest.jsonl").read_text().splitlines()]
    assert [(r["result"], r["stored"], r.get("supersedes")) for r in rows] == [("baseline", True, None), ("confirmed", False, None), ("drift", True, "2026-01-01.txt")]
    assert run("retain-result", *at, "nonsense", "2026-02-01")[0] == 2


def test_anchor_runs_chain(run, tmp_path):
    tree(tmp_path, t__a_DOT_txt="one", t__b_DOT_txt="two")
    at = (tmp_path / "t", tmp_path / "anchors")
    assert run("anchor-run", *at, "r1", "2026-01-01T00:00:00Z")[0] == 0
    assert run("anchor", tmp_path / "t", tmp_path / "anchors/manifests/r1.txt") == (0, [])
    (tmp_path / "t/b.txt").write_text("three")
    code, said = run("anchor-run", *at, "r2", "2026-01-02T00:00:00Z", "--note", "n")
    first, second = (json.loads((tmp_path / f"anchors/entries/{r}.json").read_text()) for r in ("r1", "r2"))
    assert code == 0 and second["prev_entry_sha256"] == first["entry_sha256"] and said == [f"r2  {second['entry_sha256']}"] and second["file_count"] == 2
    assert run("anchor", tmp_path / "t", tmp_path / "anchors/manifests/r1.txt") == (1, ["b.txt  changed"])
    assert run("anchor-run", *at, "r2", "2026-01-02T00:00:00Z")[0] == 2
    (tmp_path / "anchors/entries/r1.json").write_text(json.dumps(first | {"note": "forged"}))
    assert run("anchor-run", *at, "r3", "2026-01-03T00:00:00Z") == (1, ["r1"])


def test_dates_that_pages_derive(run, tmp_path):
    tree(tmp_path, md__ohio_DOT_md="# x\n**Sources last checked.** 2026-11-02\n", html__ohio_DOT_html='<dd class="docket-checked">Nov 2, 2026</dd>')
    tree(tmp_path, index_DOT_html='<tr><td><a href="/states/ohio/">x</a></td><td>y</td><td>Nov 1, 2026</td></tr>', home_DOT_html='<script id="state-index" type="application/json">[{"slug": "ohio", "checked": "Nov 2, 2026"}]</script>')
    at = (tmp_path / "md", tmp_path / "html", tmp_path / "index.html", tmp_path / "home.html")
    assert run("dates", *at) == (1, ["table  ohio  Nov 1, 2026  Nov 2, 2026"])
    (tmp_path / "index.html").write_text("")
    assert run("dates", *at) == (0, [])

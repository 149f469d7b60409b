"""Operators of the whole-page verdict, of gates and of history on the inputs that they once got wrong, and against plain loops."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.functions import text as T
from veriloom.operators import coverage, fidelity, gates, history
from veriloom.sources import packets
from veriloom.sources.html import target


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_compatibility_characters_of_all_planes(spark):
    text = "".join(chr(c) for c in (0xFB03, 0x1F110, 0x1F12B, 0x1F200, 0x2122, 0x1D400, 0x41))
    want = "".join(unicodedata.normalize("NFKC", c) if unicodedata.decomposition(c).startswith("<compat>") else c for c in text)
    assert one(spark, text, T.normalize_ligatures) == want != text


def test_the_gate_on_advice_has_its_own_phrases(spark):
    assert one(spark, "<p>You need to file.</p>", gates.advice) == ["you need to file"]
    assert one(spark, '<p>File by May. It says "you should" and &quot;be sure to&quot;.</p>', gates.advice) == []


def test_files_that_are_never_stray(spark):
    names = ["wrangler.toml", "a/predeploy-check.sh", "x.html", "x.html.tmp", ".wrangler/state.db", "a/anchors/x.ots", "node_modules/y.rs", "notes.orig", "old/b.bak", "c/b.bak", "LICENSE", "README"]
    found = gates.stray_files(spark.createDataFrame([(n,) for n in names], "path string"), ["notes.orig", "old/b.bak"])
    assert sorted(r.page for r in found.collect()) == ["README", "c/b.bak", "x.html.tmp"]


def test_notes_count_only_after_a_source_header(spark):
    note = "[the page was not captured]"
    assert one(spark, f"no header {note}", C.source_notes) == []
    assert one(spark, f"{note}\nSOURCE 1: t\nbody {note}\n", C.source_notes) == [note[1:-1]]
    assert one(spark, f"SOURCE 1 | t\nbody {note}\n", C.source_notes) == []


def test_a_day_with_more_captures_than_letters(spark):
    names = ["d.txt", *[f"d-{chr(98 + i)}.txt" for i in range(30)]]
    old = spark.createDataFrame([("s", "main", i, n, "h", ["x"], "drift") for i, n in enumerate(names)], "slug string, kind string, seq int, capture string, hash string, headers array<string>, result string")
    new = spark.createDataFrame([("s", "main", "d", "drift", "h2", ["x"])], "slug string, kind string, date string, result string, hash string, headers array<string>")
    assert history.retain(new, old).first().capture == f"d-{chr(98 + 30)}.txt"


def link(href):
    return target({"href": href} if href is not None else {})


def test_what_a_link_cites():
    said = {"mailto:a@b.org?subject=x": "a@b.org", " https://x.org/a ": "https://x.org/a", "http://x.org": "http://x.org", "tel:1": None, "/a": None, "http:x": None, "": None, None: None, "javascript:http://x": None, "a:b": None}
    assert {k: link(k) for k in said} == said


@pytest.mark.parametrize("once", [False, True])
def test_contained_equals_plain_search(spark, monkeypatch, once):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "ab", "cab", "é"])
    claims = [(i, " ".join(word() for _ in range(rng.choice((1, 2, 3, 4, 6, 9))))) for i in range(60)] + [(90, "a\n b"), (91, None), (92, "zz yy"), (93, ""), (94, "a b")]
    texts = [(i, " ".join(word() for _ in range(rng.choice((0, 1, 5, 40))))) for i in range(40)] + [(50, None), (51, "x a  b\tab")]
    c, t = spark.createDataFrame(claims, "cid int, claim string"), spark.createDataFrame(texts, "tid int, text string")
    flat = lambda x: re.sub(r"\s+", " ", x)
    want = {(i, j) for i, x in claims for j, y in texts if x is not None and y is not None and flat(x) in flat(y)}
    monkeypatch.setattr(fidelity, "CLAIM_BYTES", 200)  # several passes
    got = [(r.cid, r.tid) for r in fidelity.contained(c, t, "claim", "text", once=once).collect()]
    if once:
        assert set(got) <= want and {i for i, _ in got} == {i for i, _ in want}
    else:
        assert sorted(got) == sorted(want)


def test_phones_and_addresses_of_links(spark):
    raw = '<a href="tel:+1 (555) 010-1234">call</a> see https://x.org/555-020-1234.pdf or 555-030-1234 <a href="mailto:A@x.org?subject=q">m</a> b@x.org.'
    row = spark.createDataFrame([(raw,)], "raw string").select(C.page_phones(T.mask_tags("raw"), "raw").alias("p"), C.page_emails(T.mask_tags("raw"), "raw").alias("e")).first()
    assert row.p == ["5550301234", "5550101234"] and row.e == ["b@x.org", "a@x.org"]


def test_a_missing_quote_index_and_exit_codes(spark):
    pages = spark.createDataFrame([("s", "es", '"una cita que nadie ha escrito"')], "slug string, lang string, raw string")
    packet = spark.createDataFrame([("s", "p", "SOURCE 1: t\nuna cita que nadie ha escrito\n")], "slug string, path string, body string")
    found = fidelity.check(pages, packet)
    assert {(r.tag, r.detail) for r in found.collect()} == {("INDEX", "there is no quote index"), ("UNPAIRED", "una cita que nadie ha escrito")}
    assert fidelity.exit_code(found) == 1
    english = pages.withColumn("lang", F.lit(None).cast("string"))
    assert fidelity.exit_code(fidelity.check(english, packet)) == 0
    assert fidelity.check(pages.limit(0), packet).count() == 0


def test_sections_equal_a_plain_scan(spark):
    texts = ["## a\nx\n## b\n\n## c", "x\ny\n## a\nz\n", "", "no heading", "## only", "### deep\n## a"]
    got = packets.page_sections(spark.createDataFrame(list(enumerate(texts)), "slug int, raw string")).orderBy("slug", "pos").collect()
    want = []
    for i, t in enumerate(texts):
        n, head = 0, ""
        for pos, line in enumerate(t.split("\n")):
            if line.startswith("## "):
                n, head = n + 1, line[3:]
            want.append((i, n, head, pos, line))
    assert [tuple(r) for r in got] == want


def test_robots_text():
    assert coverage.robots("https://x.org") == "User-agent: *\nAllow: /\n\nSitemap: https://x.org/sitemap.xml\n"
    assert coverage.robots("https://x.org", ["/a"]) == "User-agent: *\nDisallow: /a\n\nSitemap: https://x.org/sitemap.xml\n"

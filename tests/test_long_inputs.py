"""Hostile lengths: work that grows with the text and no faster, and results that stay those of the plain reading."""

import random
import re
import time

from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.functions import text as T
from veriloom.sources import html


def seconds(spark, text, column):
    df = spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x"))
    began = time.time()
    out = df.collect()[0][0]
    return time.time() - began, out


def test_blanks_inside_a_line(spark):
    for n in (20_000, 400_000):
        took, out = seconds(spark, "a" + " " * n + "b  ", T.rstrip)
        assert out == "a" + " " * n + "b" and took < 5
        took, out = seconds(spark, "  a" + " " * n + "b \n", T.strip)
        assert out == "a" + " " * n + "b" and took < 5
        took, out = seconds(spark, "a" + " " * n + "b", T.pipe_table_cells)
        assert took < 5
        took, out = seconds(spark, "5" + " " * n + "x", T.strip_page_numbers)
        assert took < 5 and out


def test_strip_is_what_python_strips(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \t\n\r\x1c\x1f \xa0\x85ab|") for _ in range(rng.randrange(9))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", T.strip("t").alias("s"), T.rstrip("t").alias("r"), T.pipe_table_cells(F.col("t")).alias("p")).collect():
        t = texts[r["i"]]
        assert (r["s"], r["r"]) == (t.strip(), t.rstrip()) and r["p"] == re.sub(r"[\s\x1c-\x1f]*\|[\s\x1c-\x1f]*", " | ", t)


def test_running_sums(spark):
    for n in (0, 1, 2, 3, 10, 99, 1000):
        got = spark.range(1).select(T.running(F.expr(f"transform(sequence(1, {max(n, 1)}), i -> i % 7)" if n else "cast(array() as array<int>)"))).first()[0]
        assert got == [sum(i % 7 for i in range(1, k)) for k in range(1, n + 1)]


def test_a_hundred_thousand_quotations(spark):
    one = 'She said "a quotation that is long enough" and “another one of such length” then. '
    seconds(spark, one, C.quotes)
    took, out = seconds(spark, one * 50_000, C.quotes)
    assert len(out) == 100_000 and out[0]["text"] == "a quotation that is long enough" and took < 8
    at = out[-1]["pos"]
    assert (one * 50_000)[at : at + len(out[-1]["text"])] == out[-1]["text"]


def plain_quotes(t, least=15):
    mask, out = t, []
    for m in re.finditer("“([^“”]*)”", t):
        out.append((m.start(1), m[1]))
        mask = mask[: m.start()] + " " * len(m[0]) + mask[m.end() :]
    out += [(m.start(1), t[m.start(1) : m.end(1)]) for m in re.finditer('"([^"]*)"', mask)]
    return sorted(q for q in out if len(q[1]) >= least)


def test_quotes_of_mixed_marks(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(['"', "“", "”", "word ", "some longer words "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", C.quotes("t").alias("q")).collect():
        assert [(q["pos"], q["text"]) for q in r["q"]] == plain_quotes(texts[r["i"]])


def test_many_lines_and_parts(spark):
    line = "this is a line of the text that fills its column quite well, as it should and\n"
    took, out = seconds(spark, line * 20_000, T.unwrap_hard_wraps)
    assert took < 10 and out.count("\n") == 1 and len(out) == len(line) * 20_000
    took, out = seconds(spark, 'a <b title="x"> licence "licence" ' * 30_000, lambda c: T.outside_quotes_html(c, "licence", "license"))
    assert took < 10 and out == 'a <b title="x"> license "licence" ' * 30_000


def test_pages_of_many_open_elements(spark):
    for page in ("<body>" + "<p>x" * 100_000, "<body>" + "<div>x" * 100_000, "<body>" + "<b>" * 100_000 + "<p>x</i></u>" * 100_000, "<body>" + "<td>x" * 100_000, "<body>" + "</q>" * 100_000 + "x"):
        began = time.time()
        assert "x" in html.page_text(page)
        assert time.time() - began < 5
    began = time.time()
    html.page_text("<body>" + "<i></i> " * 50_000 + ", " * 50_000, icon_space=True)
    assert html.find(html.parse("<div class=a>" * 50_000 + "<p>"), "section div.a p") is None
    assert time.time() - began < 5


def test_elements_end_where_they_must():
    assert html.page_text("<body><ul><li>a<li>b<ul><li>c</ul><li>d</ul>e").split() == ["a", "b", "c", "d", "e"]
    rows = html.page_text("<body><table><tr><td>a<td>b <b>c<tr><th>d<td><table><tr><td>x<td>y</table>z</table>")
    assert [x.strip() for x in rows.split("\n") if x.strip()] == ["a | b c", "d | x y z | x | y"]
    kinds = [(k, v) for k, v, _ in html.parse("<p>a<b>b<div>c</div>d<select><option>1<option>2</select>")]
    assert kinds.index((html.CLOSE, "p")) < kinds.index((html.OPEN, "div")) and kinds.count((html.CLOSE, "option")) == 2
    assert sum(k == html.OPEN for k, _ in kinds) == sum(k == html.CLOSE for k, _ in kinds)


def test_a_bad_page_is_a_row(spark):
    df = spark.createDataFrame([(1, "<main>x</main>"), (2, "<p>no"), (3, None)], "i int, t string")
    got = {r["i"]: r["x"] for r in df.select("i", html.html_text_or_error(F.col("t"), "main").alias("x")).collect()}
    assert got[1]["text"] == "x" and got[1]["error"] is None and got[2]["text"] is None and "matched nothing" in got[2]["error"] and got[3]["text"] is None and got[3]["error"] is None

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.functions import dates as D
from veriloom.functions import text as T


@pytest.fixture(scope="module")
def on(spark):
    """Apply a function of a Column to texts."""

    def run(f, texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
        return [r[1] for r in df.select("i", f(F.col("c"))).orderBy("i").collect()]

    return run


SPACES = " \t\n\r\f\v\x1c\x1f\x85\xa0 　"


def test_whitespace_is_what_unicode_says(on):
    points = [chr(c) for c in [*range(1, 0x2100), 0x3000, 0xFEFF, 0x205F, 0x200B]]
    got = on(T.one_space, [f"a{c}{c}b" for c in points])
    assert got == [re.sub(r"\s+", " ", f"a{c}{c}b") for c in points]
    assert on(T.strip, [f"{SPACES}a{SPACES}b{SPACES}", SPACES, ""]) == [f"a{SPACES}b", "", ""]
    assert on(T.rstrip, [f" a{SPACES}", "a\n\n", SPACES]) == [" a", "a", ""]


def test_norm_and_squash(on):
    assert on(T.norm, ["oﬃce  beneﬁts", "the agency’s “word”"]) == ["office benefits", "the agency's “word”"]
    assert on(T.squash, ["A-b C1 é!", "漢字"]) == ["abc1", ""]
    assert on(T.normalize_apostrophes, ["‘a’ – — ​x﻿\xa0y"]) == ["'a' - -- x y"]
    assert on(T.normalize_ligatures, ["oﬃce ½ Ⅷ", None]) == ["office ½ VIII", None]
    assert on(T.strip_zero_width, ["a​b﻿c⁠d\xad"]) == ["abcd\xad"]


def test_line_filters(on):
    assert on(T.strip_page_numbers, ["a\n 12 \npage iv\nPage 3 of 10\nb\n12345\nmild\nmilk"]) == ["a\nb\n12345\nmilk"]  # mild is made of numeral letters
    assert on(T.normalize_bullets, ["• a\n\to b\n–  c\nd o e"]) == ["- a\n- b\n- c\nd o e"]
    assert on(T.collapse_blank_runs, ["a\n\n\n\nb\n\nc"]) == ["a\n\nb\n\nc"]
    assert on(T.trim_lines, ["a \t\n b\xa0\n"]) == ["a\n b\n"]
    assert on(T.pipe_table_cells, ["a|b \n| c"]) == ["a | b | c"]
    assert on(T.join_wrap_hyphens, ["word-for-\nword and-\nNot"]) == ["word-for-word and-\nNot"]
    assert on(T.flatten_retrieved, ["Retrieved: 2026-01-02 retrieved:2025-12-31"]) == ["Retrieved: X retrieved:X"]
    assert on(lambda c: T.apply_filters(c, ["trim-lines", "collapse-blank-runs"]), ["a \n \n \n\fb"]) == ["a\n\n\nb"]
    with pytest.raises(KeyError):
        T.apply_filters("c", ["no such filter"])


def plain_width(t):
    n = sorted(len(x.rstrip()) for x in t.split("\n") if x.strip())
    return max(40, 5 * round((n[min(len(n) - 1, int(len(n) * 0.9))] - 12) / 5)) if n else 40


def plain_unwrap(t, width=None):
    width = width or plain_width(t)
    out = []
    for line in t.split("\n"):
        s, prev = line.rstrip(), out[-1] if out else ""
        full = prev.strip() and s.strip() and len(prev) >= width
        stop = re.search(r"[.:;?!][\"')\]]?\s*$", prev) or re.match(r"^\s*(?:[-•]|\(?[a-zA-Z0-9]{1,3}[.)])\s", s) or "|" in prev + s
        if full and not stop:
            out[-1] = prev.rstrip() + " " + s.strip()
        else:
            out.append(s)
    return "\n".join(out)


def plain_repeats(t, floor=3):
    lines = t.splitlines()
    n: dict = {}
    for x in lines:
        n[x.strip()] = n.get(x.strip(), 0) + 1
    return "\n".join(x for x in lines if not x.strip() or n[x.strip()] < floor)


def plain_heads(t):
    rows = []
    for page in (pages := [p.split("\n") for p in t.split("\f")]):
        live = [i for i, x in enumerate(page) if x.strip()]
        edge = set(live[:2] + live[-2:]) if len(pages) > 1 else set()
        rows += [(x, i in edge) for i, x in enumerate(page)]
    width = plain_width("\n".join(x for x, _ in rows))
    fold = lambda x: re.sub(r"\d+", "#", " ".join(x.split()))
    able = lambda x, e: e and 3 <= len(" ".join(x.split())) < width and re.search("[A-Za-z]", x)
    n: dict = {}
    for x, e in rows:
        if able(x, e):
            n[fold(x)] = n.get(fold(x), 0) + 1
    return "\n".join(x for x, e in rows if not (able(x, e) and n[fold(x)] >= 3))


line = st.sampled_from(["", " ", "Head 1", "Head  22", "x" * 45, "word " * 11, "ends here. ", "- item", "a | b", "(1) x", "same", "  same\t", "é" * 50 + "-", "12"])
texts = st.lists(st.lists(line, max_size=7).map("\n".join), min_size=1, max_size=5)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=20, max_size=40))
def test_folds_equal_plain_loops(on, many):
    flat = ["\n".join(t) for t in many]
    assert on(T.width_of, flat) == [plain_width(t) for t in flat]
    assert on(T.unwrap_hard_wraps, flat) == [plain_unwrap(t) for t in flat]
    assert on(T.strip_repeats, flat) == [plain_repeats(t) for t in flat]
    paged = ["\f".join(t) for t in many]
    assert on(T.strip_running_headers, paged) == [plain_heads(t) for t in paged]


def test_split_lines_knows_all_line_ends(on):
    t = "a\nb\r\nc\rd\x0be\x0cf\x1cg\x85h i "
    assert on(T.split_lines, [t])[0] == t.splitlines()


def test_slices(on):
    t = "intro (see 5.1) Start \n here one end two end three Start here four end"
    assert on(lambda c: T.slice_between(c, "Start here", "end"), [t]) == ["Start \n here one "]
    assert on(lambda c: T.slice_between(c, "Start here", "end", 1, 2), [t]) == ["Start \n here one end two "]
    assert on(lambda c: T.slice_between(c, "Start here", None, 2), [t]) == ["Start here four end"]
    assert on(lambda c: T.slice_between(c, "(see 5.1)", "one"), [t]) == ["(see 5.1) Start \n here "]
    for bad in (("absent", None, 1, 1), ("Start here", "end", 1, 9), ("Start here", None, 3, 1)):
        with pytest.raises(Exception, match="anchor"):
            on(lambda c, b=bad: T.slice_between(c, *b), [t])
    assert on(lambda c: T.shortest_unique(c, F.lit(0), 3, 10), ["abcabcdabcdex", "aaa"]) == ["abca", "aaa"]


def plain_quotes(t, least=15):
    found, mask = [], list(t)
    for m in re.finditer("“([^“”]*)”", t):
        found.append((m.start(1), m[1]))
        mask[m.start() : m.end()] = " " * len(m[0])
    found += [(m.start(1), t[m.start(1) : m.end(1)]) for m in re.finditer('"([^"]*)"', "".join(mask))]
    return sorted(x for x in found if len(x[1]) >= least)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["“", "”", '"', "a long enough quotation", "short", " ", "\n", "‘x’"]), max_size=12).map("".join), min_size=20, max_size=40))
def test_quotes_equal_the_plain_reading(on, many):
    got = on(C.quotes, many)
    assert [[(q["pos"], q["text"]) for q in row] for row in got] == [plain_quotes(t) for t in many]


def test_contacts(on):
    assert on(C.phones, ["call (202) 555-0123 or 1-800-555-0199, 202.555.0123 or 555-1234"]) == [["2025550123", "8005550199"]]
    assert on(C.emails, ["A.B@Example.ORG. and x@y.co..."]) == [["a.b@example.org", "x@y.co"]]
    assert on(C.addresses, ["at 1401 West Capitol Ave, Suite 4 or P.O. Box 12. Not 12 rooms"]) == [["1401 west capitol ave", "p.o. box 12"]]
    inside = lambda e: C.address_in(F.lit("12 main street 450"), e)
    assert on(inside, ["see 12 Main\nStreet 450.", "see 112 Main Street 450", "12 Main Street 4501", ""]) == [True, False, False, False]
    assert on(lambda e: C.address_in(F.lit("12 main st"), e), ["12 main st"]) == [False]
    assert on(C.host, ["https://User@Ex.com:80/a", "/rel", None]) == ["user@ex.com:80", None, None]
    assert on(C.bare_host, ["https://User@Ex.com:80/a", "data:x", None]) == ["ex.com", None, None]
    assert on(C.external_links, ['<a href="https://a.b/?x&amp;y">[t](http://c.d/e) <a href="/r"> <a href="https://a.b/?x&amp;y">']) == [["https://a.b/?x&y", "http://c.d/e"]]
    assert on(C.annotations, ["[page truncated by extractor] [§300.504(a) of the law] [sic]"]) == [["page truncated by extractor"]]


def test_change_log(on):
    for head in ("## 04 Change log", "## 04 · Change log", "## 04. Change log", "## Change log", "<h2> Change log </h2>", '<div class="section-no">04<'):
        assert on(C.live_part, [f"live\n{head}\nold"]) == ["live\n"]
    assert on(C.live_part, ["no log here"]) == ["no log here"]


def test_dates(on):
    assert on(D.display, ["2026-11-04", "2026-13-04", "soon", "2026-02-31"]) == ["Nov 4, 2026", "2026-13-04", "soon", "Feb 31, 2026"]
    assert [str(x) for x in on(D.tolerant_date, ["2026-02-28", "2026-02-31", "x", None])] == ["2026-02-28", "None", "None", "None"]
    assert [str(x) for x in on(D.stamp, ["2026-10-06T031500Z", "nope"])] == ["2026-10-06 03:15:00", "None"]
    assert [str(x) for x in on(lambda c: D.previous_month(F.to_date(c))[1], ["2026-01-15", "2026-03-31"])] == ["2025-12-31", "2026-02-28"]
    assert on(D.assembled, ["x\nASSEMBLED: 2026-01-02\n", "Assembly date: 2025-01-01", "none"]) == ["2026-01-02", "2025-01-01", None]


def test_markup(on):
    assert on(T.mask_tags, ["<p>a &amp;lt; b</p>"]) == [" a &lt; b "]
    assert on(T.html_escape, ['<a&"b>']) == ["&lt;a&amp;&quot;b&gt;"]
    assert on(lambda c: T.outside_quotes(c, lambda x: F.replace(x, F.lit("licence"), F.lit("license"))), ['licence "licence" licence']) == ['license "licence" license']
    assert on(lambda c: T.outside_quotes_html(c, "licence", "license"), ['<p title="licence">licence "the <b>licence</b>" licence']) == ['<p title="licence">license "the <b>licence</b>" license']
    assert on(T.drop_navigation_links, ['<link rel="canonical" href="https://x/"><link rel="stylesheet" href="/a.css">']) == ['<link rel="stylesheet" href="/a.css">']
    assert on(lambda c: T.mask_block(c, "<!--a-->", "<!--b-->"), ["x<!--a-->y\nz<!--b-->w"]) == ["x w"]

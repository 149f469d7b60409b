"""Text normalisation and filters, as Column expressions that stay inside code generation.

Whitespace is the set that Unicode-aware text tools strip: Java's Unicode class plus the four
information separators. A filter maps a Column to a Column; FILTERS names them, and apply_filters folds
a list of names in the given order, which matters.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"[\s\x1c-\x1f]"
U = "(?U)"
#: Characters that end a line for splitlines(): LF, VT, FF, CR, FS, GS, RS, NEL, LS, PS; CR LF is one end.
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"

# What apostrophe, dash and space glyphs become, and ligatures by their letters.
GLYPHS = {
    "‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"',
    "–": "-", "—": "--", "−": "-", " ": " ", "​": "", "﻿": "",
}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
APOSTROPHES = {"’": "'", "‘": "'", "ʼ": "'"}
ZERO_WIDTH = "​﻿⁠"
BULLETS = "•▪●◦·⁃∙o*–"
WIDTH_FLOOR, WIDTH_SLACK = 40, 12
SENTENCE_END = r"""(?U)[.:;?!]["')\]]?[\s\x1c-\x1f]*$"""
LIST_ITEM = r"(?U)^[\s\x1c-\x1f]*(?:[-•]|\(?[a-zA-Z0-9]{1,3}[.)])[\s\x1c-\x1f]"
HEAD_REPEATS, HEAD_EDGE, HEAD_CHARS = 3, 2, 3
# End of fixed values.


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: a Column used inside another's lambda is computed anew for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def fields(columns: list) -> str:
    """A schema text of fields, or of texts "name type"."""
    return ", ".join(c if isinstance(c, str) else f"`{c.name}` {c.dataType.simpleString()}" for c in columns)


def replace_all(c: Column, pairs: dict[str, str]) -> Column:
    """One pass of translate() for one-to-one pairs, then replace() for the rest."""
    one = {k: v for k, v in pairs.items() if len(k) == 1 and len(v) <= 1}
    if one:
        kept = [k for k, v in one.items() if v] + [k for k, v in one.items() if not v]
        c = F.translate(c, "".join(kept), "".join(one[k] for k in kept))
    for k, v in pairs.items():
        if k not in one:
            c = F.replace(c, F.lit(k), F.lit(v))
    return c


def running(sizes: Column) -> Column:
    """Sums of an array's elements before each one: 0 first. In pieces of the square root of its length, as an array that grows is copied at each step."""
    none = F.expr("cast(array() as array<int>)")
    fold = lambda v: F.aggregate(v, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))
    step = lambda v: F.ceil(F.sqrt(F.size(v))).cast("int")
    cut = lambda v: let(step(v), lambda n: F.transform(F.sequence(F.lit(1), F.size(v), n), lambda i: fold(F.slice(v, i, n))))
    joined = lambda p: let(fold(F.transform(p, lambda x: x["at"]))["out"], lambda before: F.flatten(F.zip_with(p, before, lambda x, b: F.transform(x["out"], lambda y: y + b))))
    return let(sizes, lambda v: F.when(F.size(v) > 0, let(cut(v), joined)).otherwise(none))


# A run of blanks is taken whole, and only from its begin on, so that a long one inside a text is looked at once.
def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"{U}^{WS}++|(?<!{WS}){WS}++\\z", "")


def rstrip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"{U}(?<!{WS}){WS}++\\z", "")


def one_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"{U}{WS}+", " ")


def no_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"{U}{WS}+", "")


def norm(c: Column | str) -> Column:
    """Comparison form: ligatures and apostrophes folded, each run of whitespace one space. Double quotes stay."""
    return one_space(replace_all(_col(c), LIGATURES | APOSTROPHES))


def squash(c: Column | str) -> Column:
    """Lower-case ASCII letters and digits only; texts of other scripts all become empty."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "")


def lines(c: Column | str) -> Column:
    """Lines parted by LF alone."""
    return F.split(_col(c), "\n", -1)


def split_lines(c: Column | str) -> Column:
    """Lines parted by any line end; a final one opens no line."""
    return F.split(F.regexp_replace(_col(c), f"(?:{LINE_END})\\z", ""), LINE_END, -1)


def non_blank(c: Column | str) -> Column:
    """How many lines hold more than whitespace."""
    return F.size(F.filter(split_lines(c), lambda x: x.rlike(f"{U}[^\\s\\x1c-\\x1f]")))


def body_hash(c: Column | str) -> Column:
    """16 hex digits of SHA-256."""
    return F.substring(F.sha2(_col(c), 256), 1, 16)


def artifact_id(content: Column | str) -> Column:
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(_col(content), 256), 1, 16))


def flatten_retrieved(c: Column | str) -> Column:
    """Retrieval dates as X, so that two captures of an unchanged source compare equal."""
    return F.regexp_replace(_col(c), r"(?i)(retrieved:\s*)\d{4}-\d{2}-\d{2}", "$1X")


def normalize_apostrophes(c: Column) -> Column:
    return replace_all(c, GLYPHS)


@functools.cache
def _compat() -> dict[str, str]:
    """Code points whose decomposition is tagged compat, and their NFKC form."""
    return {ch: unicodedata.normalize("NFKC", ch) for ch in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decomposition(ch).startswith("<compat>")}


def normalize_ligatures(c: Column) -> Column:
    """Compatibility characters by their letters, from the Unicode tables; other characters stay as they are."""
    table = str.maketrans(_compat())

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or x.isascii() else x.translate(table))

    return fold(c)


def strip_zero_width(c: Column) -> Column:
    return F.translate(c, ZERO_WIDTH, "")


def normalize_bullets(c: Column) -> Column:
    return F.regexp_replace(c, f"(?Um)(?d)^[ \t]*[{BULLETS}]{WS}+", "- ")


def strip_page_numbers(c: Column) -> Column:
    number = r"(?i)(?U)^[\s\x1c-\x1f]*+(?:page[\s\x1c-\x1f]++)?(?:[ivxlcdm]+|\d{1,4})[\s\x1c-\x1f]*+(?:of[\s\x1c-\x1f]++\d{1,4}[\s\x1c-\x1f]*+)?$"
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(number)), "\n")


def width_of(c: Column | str) -> Column:
    """The text's column width: the length at nine tenths of its non-blank lines, less slack, to the nearest five (half to even)."""
    sizes = F.array_sort(F.transform(F.filter(lines(c), lambda x: x.rlike(f"{U}[^\\s\\x1c-\\x1f]")), lambda x: F.length(rstrip(x))))

    def width(s: Column) -> Column:
        at = F.least(F.size(s), F.floor(F.size(s) * F.lit(0.9)).cast("int") + 1)
        wide = (F.bround((F.try_element_at(s, at) - WIDTH_SLACK) / 5, 0) * 5).cast("int")
        return F.when(F.size(s) > 0, F.greatest(F.lit(WIDTH_FLOOR), wide)).otherwise(F.lit(WIDTH_FLOOR))

    return let(sizes, width)


def unwrap_hard_wraps(c: Column, width: Column | None = None) -> Column:
    """Join a line to the text before it if that fills the column, ends no sentence and neither is a list item or a table row.

    A text that was joined fills the column ever after, so that a line joins by what it and the line before are, and either the line before is long or
    it was joined itself. Each line is a letter by that: x (never), L (the line before is long), o (if the line before joined); an x or an o with the
    L and what follows it are one line of the result. Linear: the letters are matched once, and lines are cut out by running sums.
    """
    has = lambda x: x.rlike(f"{U}[^\\s\\x1c-\\x1f]")

    def letter(s: Column, prev: Column, w: Column) -> Column:
        joins = has(prev) & has(s) & ~prev.rlike(SENTENCE_END) & ~s.rlike(LIST_ITEM) & ~F.contains(prev, F.lit("|")) & ~F.contains(s, F.lit("|"))
        return F.when(F.coalesce(joins, F.lit(False)), F.when(F.length(prev) >= w, "L").otherwise("o")).otherwise("x")

    def joined(rows: Column, w: Column) -> Column:
        letters = F.array_join(F.transform(rows, lambda s, i: letter(s, F.when(i > 0, F.get(rows, i - 1)), w)), "")
        sizes = lambda g: F.transform(g, F.length)
        line = lambda n, at: F.array_join(F.transform(F.slice(rows, at + 1, n), lambda x, k: F.when(k == 0, x).otherwise(strip(x))), " ")
        return let(sizes(F.regexp_extract_all(letters, F.lit("([xo](?:L[Lo]*)?)"), F.lit(1))), lambda n: let(running(n), lambda at: F.array_join(F.zip_with(n, at, line), "\n")))

    rows = lambda w: let(F.transform(lines(c), rstrip), lambda v: joined(v, w))
    return let(width_of(c) if width is None else width, rows)


def collapse_blank_runs(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def repeated_lines(texts: DataFrame, key: str, text: str = "text", floor: int = HEAD_REPEATS) -> DataFrame:
    """(key, line, times): lines, trimmed and not blank, that a text holds `floor` times or more. Lines are counted before they are shuffled."""
    rows = texts.select(key, F.explode(lines(text)).alias("line")).select(key, strip("line").alias("line")).where("line <> ''")
    return rows.groupBy(key, "line").agg(F.count("*").alias("times")).where(F.col("times") >= floor)


def trim_lines(c: Column) -> Column:
    return F.array_join(F.transform(lines(c), rstrip), "\n")


def pipe_table_cells(c: Column) -> Column:
    return F.regexp_replace(c, f"{U}(?:(?<!{WS}){WS}++)?\\|{WS}*+", " | ")


def join_wrap_hyphens(c: Column) -> Column:
    return F.regexp_replace(c, "-\n(?=[a-z])", "-")


def form_feed_to_line(c: Column) -> Column:
    return F.translate(c, "\f", "\n")


def strip_running_headers(c: Column) -> Column:
    """Drop lines at page edges (two non-blank lines deep) that recur on three pages, digits alike; page breaks become line ends.

    Such a line is shorter than the column, of three characters or more, and holds a letter. A text of
    one page loses nothing. All within one row: pages and lines are arrays.
    """
    blank = lambda x: ~x.rlike(f"{U}[^\\s\\x1c-\\x1f]")
    tidy = lambda x: strip(one_space(x))
    key = lambda x: F.regexp_replace(tidy(x), r"(?U)\d+", "#")
    pages = F.transform(F.split(c, "\f", -1), lambda p: F.split(p, "\n", -1))
    flat = F.replace(c, F.lit("\f"), F.lit("\n"))

    def marked(p: Column, width: Column) -> Column:
        live = F.filter(F.transform(p, lambda x, i: F.when(~blank(x), i)), lambda i: i.isNotNull())
        edges = let(live, lambda v: F.array_union(F.slice(v, F.lit(1), F.lit(HEAD_EDGE)), F.slice(F.reverse(v), F.lit(1), F.lit(HEAD_EDGE))))
        fits = lambda t: (F.length(t) < width) & (F.length(t) >= HEAD_CHARS) & t.rlike("[A-Za-z]")
        return let(edges, lambda e: F.transform(p, lambda x, i: F.struct(x.alias("line"), F.when(F.array_contains(e, i) & fits(tidy(x)), key(x)).alias("head"))))

    def kept(rows: Column) -> Column:
        heads = F.filter(F.transform(rows, lambda r: r["head"]), lambda h: h.isNotNull())
        return let(recurring(heads, HEAD_REPEATS), lambda drop: F.array_join(F.transform(F.filter(rows, lambda r: r["head"].isNull() | ~F.array_contains(drop, r["head"])), lambda r: r["line"]), "\n"))

    many = let(F.struct(pages.alias("pages"), width_of(flat).alias("width")), lambda v: let(F.flatten(F.transform(v["pages"], lambda p: marked(p, v["width"]))), kept))
    return F.when(F.contains(c, F.lit("\f")), many).otherwise(c)


def recurring(keys: Column, floor: int) -> Column:
    """Distinct elements that an array has `floor` times or more: equal neighbours of the sorted array."""
    at = lambda k: F.sequence(F.lit(0), F.greatest(F.size(k) - floor, F.lit(0)))
    hit = lambda k: F.transform(at(k), lambda i: F.when(F.get(k, i) == F.get(k, i + floor - 1), F.get(k, i)))
    return let(F.array_sort(keys), lambda k: F.array_distinct(F.filter(hit(k), lambda x: x.isNotNull())))


FILTERS: dict[str, Callable[[Column], Column]] = {
    "normalize-apostrophes": normalize_apostrophes,
    "normalize-ligatures": normalize_ligatures,
    "strip-zero-width": strip_zero_width,
    "normalize-bullets": normalize_bullets,
    "strip-page-numbers": strip_page_numbers,
    "unwrap-hard-wraps": unwrap_hard_wraps,
    "collapse-blank-runs": collapse_blank_runs,
    "trim-lines": trim_lines,
    "pipe-table-cells": pipe_table_cells,
    "strip-running-headers": strip_running_headers,
    "join-wrap-hyphens": join_wrap_hyphens,
}


def apply_filters(c: Column | str, names: list[str]) -> Column:
    """The named filters in order; form feeds that are left become line ends. An unknown name fails when the plan is built."""
    out = functools.reduce(lambda acc, n: FILTERS[n](acc), names, _col(c))
    return form_feed_to_line(out)


def strip_repeats(c: Column | str, floor: int = HEAD_REPEATS) -> Column:
    """Without the lines that recur `floor` times or more anywhere in the text; blank lines stay.

    Counts are taken on the sorted array of the text's lines, so cost is that of one sort in the row.
    """
    keys = lambda rows: F.filter(F.transform(rows, strip), lambda k: k != "")
    kept = lambda rows, often: F.filter(rows, lambda x: ~F.array_contains(often, strip(x)))
    return F.array_join(let(split_lines(c), lambda rows: let(recurring(keys(rows), floor), lambda often: F.when(F.size(often) == 0, rows).otherwise(kept(rows, often)))), "\n")


def elastic(anchor: str) -> str:
    """A pattern for an anchor whose whitespace is elastic and whose other characters are themselves."""
    return "(?U)" + f"{WS}+".join("\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in anchor.split())


def elastic_of(anchor: Column) -> Column:
    """elastic() of anchors that are a column."""
    quoted = lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.concat(F.lit(U), F.array_join(F.transform(F.split(strip(anchor), f"{U}{WS}+"), quoted), f"{WS}+"))


def slice_of(c: Column, start: Column, stop: Column, start_n: Column, stop_n: Column) -> Column:
    """slice_between() by anchors and occurrences that are columns: each row its own. A null or empty stop is the text's end."""
    cut = lambda t, anchor, n: let(F.split(t, elastic_of(anchor), n + 1), lambda v: F.when(F.size(v) > n, v))
    # The text before the n-th occurrence is what is left once the rest and the match are taken off: pieces and matches, in turn.
    found = lambda t, anchor, n: F.slice(F.regexp_extract_all(t, elastic_of(anchor), F.lit(0)), F.lit(1), n)
    length = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + F.length(y))

    def span(t: Column, what: str, anchor: Column, n: Column) -> Column:
        missing = F.raise_error(F.concat(F.lit(f"{what} anchor "), anchor, F.lit(" has no occurrence "), n.cast("string")))
        place = lambda v, m: F.struct((length(F.slice(v, F.lit(1), n)) + length(F.slice(m, F.lit(1), n - 1))).alias("start"), (length(F.slice(v, F.lit(1), n)) + length(m)).alias("end"))
        return let(cut(t, anchor, n), lambda v: F.when(v.isNull(), missing).otherwise(let(found(t, anchor, n), lambda m: place(v, m))))

    whole = F.coalesce(stop, F.lit("")) == ""
    tail = lambda a: F.substr(c, a["end"] + 1)
    between = lambda a: let(tail(a), lambda t: let(span(t, "to", stop, stop_n), lambda b: F.substr(c, a["start"] + 1, a["end"] - a["start"] + b["start"])))
    return let(span(c, "from", start, start_n), lambda a: F.when(whole, F.substr(c, a["start"] + 1)).otherwise(between(a)))


def nth_span(c: Column | str, pattern: str, n: int = 1) -> Column:
    """struct(start, end) of the n-th match, from 0, end exclusive; null if there are fewer.

    The pieces between matches and the matches themselves give the offsets: no built-in returns the n-th place.
    """
    c = _col(c)
    pieces = F.slice(F.split(c, pattern, n + 1), F.lit(1), F.lit(n))
    found = F.slice(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.lit(1), F.lit(n))
    before = F.aggregate(pieces, F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(found, F.lit(1), F.lit(n - 1)) if n > 1 else F.expr("cast(array() as array<string>)"), F.lit(0), lambda a, x: a + F.length(x))
    return F.when(F.regexp_count(c, F.lit(pattern)) >= n, F.struct(before.alias("start"), (before + F.length(F.try_element_at(found, F.lit(n)))).alias("end")))


def slice_between(c: Column | str, start: str, stop: str | None = None, start_n: int = 1, stop_n: int = 1) -> Column:
    """From the start anchor to before the stop anchor, searched after it, or to the end; a missing anchor fails the query."""
    c = _col(c)
    a = nth_span(c, elastic(start), start_n)
    missing = lambda what, anchor, n: F.raise_error(F.lit(f"{what} anchor {anchor!r} has no occurrence {n}"))
    if not stop:
        return F.when(a.isNull(), missing("from", start, start_n)).otherwise(F.substr(c, a["start"] + 1))
    tail = F.substr(c, a["end"] + 1)
    b = nth_span(tail, elastic(stop), stop_n)
    return F.when(a.isNull(), missing("from", start, start_n)).when(b.isNull(), missing("to", stop, stop_n)).otherwise(F.substr(c, a["start"] + 1, a["end"] - a["start"] + b["start"]))


def shortest_unique(c: Column | str, at: Column, least: int = 45, most: int = 200) -> Column:
    """The shortest prefix, `least` to `most` characters, of the text from a place on that occurs once in the text; else null."""
    c = _col(c)
    once = lambda n: let(F.substr(c, at + 1, n), lambda p: (F.length(c) - F.length(F.replace(c, p, F.lit("")))) == F.length(p))
    # A longer prefix occurs no more often: the least that occurs once is found by halving, and most texts end at the first test.
    top = F.least(F.lit(most), F.length(c) - at)
    span = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))
    halve = lambda s, _: let(F.floor((s["low"] + s["high"]) / 2), lambda m: F.when(s["low"] >= s["high"], s).when(once(m), span(s["low"], m)).otherwise(span(m + 1, s["high"])))
    steps = F.sequence(F.lit(1), F.lit(max(1, (most - least).bit_length())))
    longer = let(F.aggregate(steps, span(F.lit(least + 1), top), halve)["low"], lambda n: F.when(once(n), F.substr(c, at + 1, n)))
    return F.when(top < least, None).when(once(F.lit(least)), F.substr(c, at + 1, F.lit(least))).when(top > least, longer)


def locate(full: Column | str, body: Column | str, head: int = 120) -> Column:
    """struct(start, end) of a body in a text, both in normal form, by its first characters; null if it is empty or not there."""
    at = lambda f, b: F.instr(f, F.substr(b, F.lit(1), F.lit(head))) - 1
    span = lambda f, b: F.when((b != "") & (at(f, b) >= 0), F.struct(at(f, b).alias("start"), (at(f, b) + F.length(b)).alias("end")))
    return let(F.struct(norm(full).alias("f"), norm(body).alias("b")), lambda x: span(x["f"], x["b"]))


def grow(c: Column | str, at: Column, least: int = 45, most: int = 200) -> Column:
    """An anchor for a slice: whole words from a place on, `least` characters or more, as few as occur once in the text; if none does,
    those that first exceed `most` characters, or all of the next 400."""
    c = _col(c)
    once = lambda p: (F.length(c) - F.length(F.replace(c, p, F.lit("")))) == F.length(p)
    tries = lambda w: F.transform(F.sequence(F.lit(1), F.size(w)), lambda n: F.trim(F.array_join(F.slice(w, F.lit(1), n), " ")))
    fit = lambda v: F.filter(v, lambda x, k: (F.length(x) >= least) & ((k == 0) | (F.length(F.get(v, k - 1)) <= most)))
    last = lambda e: F.try_element_at(e, F.lit(-1))
    pick = lambda v: let(fit(v), lambda e: F.coalesce(F.get(F.filter(e, once), 0), last(e), last(v)))
    return let(F.split(F.substr(c, at + 1, F.lit(400)), " ", -1), lambda w: let(tries(w), pick))


def outside_quotes(c: Column | str, change: Callable[[Column], Column]) -> Column:
    """Change only text outside ASCII double quotes; an open quote runs to the end."""
    return F.array_join(F.transform(F.split(_col(c), '"', -1), lambda x, i: F.when(i % 2 == 0, change(x)).otherwise(x)), '"')


def outside_quotes_html(c: Column | str, old: str, new: str) -> Column:
    """Replace a word outside tags and quotations of a page; tags are kept as they are."""
    parts = F.regexp_extract_all(_col(c), F.lit(r"(<[^>]*>|[^<]+|<)"), F.lit(1))
    pieces = lambda p: F.split(p, '"', -1)
    marks = lambda v: F.transform(v, lambda p: F.when(p.startswith("<"), 0).otherwise(F.size(pieces(p)) - 1))
    spelled = lambda p, before: F.array_join(F.transform(pieces(p), lambda x, i: F.when((i + before) % 2 == 0, F.replace(x, F.lit(old), F.lit(new))).otherwise(x)), '"')
    each = lambda v, seen: F.zip_with(v, seen, lambda p, before: F.when(p.startswith("<"), p).otherwise(spelled(p, before)))
    return let(parts, lambda v: let(running(marks(v)), lambda seen: F.array_join(each(v, seen), "")))


# Character entities that pages use, the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&nbsp;": " ", "&amp;": "&"}


def html_unescape(c: Column | str) -> Column:
    return functools.reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), ENTITIES.items(), _col(c))


def html_escape(c: Column | str) -> Column:
    return functools.reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")], _col(c))


def mask_tags(c: Column | str) -> Column:
    """Tags as one space each, then entities as characters."""
    return html_unescape(F.regexp_replace(_col(c), "<[^>]+>", " "))


def mask_block(c: Column | str, start: str, stop: str) -> Column:
    """Blocks between two literal marks, marks included, as one space each."""
    return F.regexp_replace(_col(c), f"(?s)\\Q{start}\\E.*?\\Q{stop}\\E", " ")


def drop_navigation_links(c: Column | str) -> Column:
    """<link> tags that navigate (alternate, canonical, prev, next, me) removed."""
    return F.regexp_replace(_col(c), r'(?i)<link\b(?=[^>]*\brel\s*=\s*"(?:alternate|canonical|prev|next|me)")[^>]*>', "")


def describe(c: Column | str, most: int = 157) -> Column:
    """A plain one-line description: markdown links and emphasis dropped, cut at a word with an ellipsis if too long."""
    plain = F.regexp_replace(F.regexp_replace(_col(c), r"\[([^\]]*)\]\([^)]*\)", "$1"), r"[*_`#>]", "")
    flat = strip(one_space(plain))
    cut = F.regexp_extract(flat, f"^(.{{0,{most}}})\\s", 1)
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(rstrip(cut), F.lit("…")))

"""Captures of documents as text "packets": readers of the header dialects, and a writer.

Three readers disagree on purpose and stay apart: the canonical one (colon, pipe or bare headers; END SOURCE
ends a block where it occurs), the strict one that hashes are made by (colon headers only, END SOURCE is body),
and the lenient one for drafting slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.functions.text import _col

# How packets mark their parts.
HEADER = r"(?m)(?d)^SOURCE\s*(\d+)\s*(?:[|:]|$)"
HEADER_AHEAD = r"(?m)(?d)^(?=SOURCE\s*\d+\s*(?:[|:]|$))"
STRICT_AHEAD = r"(?m)(?d)^(?=SOURCE\s+\d+:)"
END_SOURCE = r"(?m)(?d)^(?:END SOURCE\b|END OF PACKET\b).*$"
# End of fixed values.


def files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(path, raw) of text files below a path, each whole."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def header_part(c: Column | str) -> Column:
    """What stands before the first source: description, never evidence. All of it if there is none."""
    at = F.regexp_instr(_col(c), F.lit(HEADER))
    return F.when(at > 0, F.substr(_col(c), F.lit(1), at - 1)).otherwise(_col(c))


def blocks(c: Column | str) -> Column:
    """array<struct(n, header, body)> of a packet; of a number that repeats the last block counts."""
    parts = F.filter(F.split(_col(c), HEADER_AHEAD, -1), lambda b: b.rlike(HEADER))
    line = lambda b: F.get(F.split(b, "\n", 2), 0)
    rest = lambda b: F.coalesce(F.get(F.split(b, "\n", 2), 1), F.lit(""))
    body = lambda b: F.regexp_replace(F.get(F.split(rest(b), END_SOURCE, 2), 0), r"^\n+|\n+\z", "")
    all_ = F.transform(parts, lambda b: F.struct(F.regexp_extract(b, HEADER, 1).cast("int").alias("n"), line(b).alias("header"), body(b).alias("body")))
    return T.let(all_, lambda v: F.filter(v, lambda x, i: ~F.exists(F.slice(v, i + 2, F.size(v)), lambda y: y["n"] == x["n"])))


def sources(packets: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """One row a source: packets' columns (or keep) and n, header, body."""
    keep = keep if keep is not None else [c for c in packets.columns if c != raw]
    return packets.select(*keep, F.explode(blocks(raw)).alias("b")).select(*keep, "b.n", "b.header", "b.body")


def strict_blocks(c: Column | str) -> Column:
    """array<struct(n, header, body)> by colon headers alone; END SOURCE lines stay in the body."""
    parts = F.filter(F.split(_col(c), STRICT_AHEAD, -1), lambda b: b.rlike(r"^SOURCE\s+\d+:"))
    line = lambda b: F.get(F.split(b, "\n", 2), 0)
    return F.transform(parts, lambda b: F.struct(F.regexp_extract(b, r"^SOURCE\s+(\d+):", 1).cast("int").alias("n"), line(b).alias("header"), F.substr(b, F.length(line(b)) + 1).alias("body")))


def lenient_bodies(c: Column | str) -> Column:
    """map n -> body: cut at END SOURCE of the same number if it is there."""
    parts = F.filter(F.split(_col(c), r"(?m)(?d)^(?=SOURCE\s+\d+)", -1), lambda b: b.rlike(r"^SOURCE\s+\d+"))
    n = lambda b: F.regexp_extract(b, r"^SOURCE\s+(\d+)", 1)
    text = lambda b: F.get(F.split(F.coalesce(F.get(F.split(b, "\n", 2), 1), F.lit("")), F.concat(F.lit("(?m)^END SOURCE "), n(b), F.lit(r"\b")), 2), 0)
    pairs = F.transform(parts, lambda b: F.struct(n(b).cast("int"), text(b)))
    return T.let(pairs, lambda v: F.map_from_entries(F.filter(v, lambda x, i: ~F.exists(F.slice(v, i + 2, F.size(v)), lambda y: y["col1"] == x["col1"]))))


def source_region(c: Column | str) -> Column:
    """From the first source on; all of the text if it has none."""
    c = _col(c)
    head = header_part(c)
    return F.when(c.rlike(HEADER), F.substr(c, F.length(head) + 1)).otherwise(c)


def source_bodies(c: Column | str) -> Column:
    """source_region without header lines; all of the text if it has none."""
    c = _col(c)
    return F.when(c.rlike(HEADER), F.regexp_replace(source_region(c), r"(?m)(?d)^SOURCE\s*\d+\s*(?:[|:].*)?$", "")).otherwise(c)


def headers(c: Column | str) -> Column:
    """Colon header lines in order, trimmed."""
    return F.transform(F.regexp_extract_all(_col(c), F.lit(r"(?m)(?d)^SOURCE\s+\d+:.*$"), F.lit(0)), T.strip)


def urls(c: Column | str) -> Column:
    """The first address of each header line, in order."""
    found = F.transform(headers(c), lambda h: F.regexp_extract(h, r"https?://[^\s|]+", 0))
    return F.filter(found, lambda u: u != "")


def artifacts(c: Column | str) -> Column:
    """map n -> artifact id, from the capture notes."""
    notes = F.regexp_extract_all(header_part(c), F.lit(r"(?m)^- SOURCE \d+:.*artifact sha256:[0-9a-f]{16}"), F.lit(0))
    pairs = F.transform(notes, lambda x: F.struct(F.regexp_extract(x, r"SOURCE (\d+):", 1).cast("int"), F.regexp_extract(x, r"artifact (sha256:[0-9a-f]{16})", 1)))
    return T.let(pairs, lambda v: F.map_from_entries(F.filter(v, lambda x, i: ~F.exists(F.slice(v, i + 2, F.size(v)), lambda y: y["col1"] == x["col1"]))))


def normalized_body(c: Column | str) -> Column:
    """The text that a body hash is of: sources only, colon headers dropped, whitespace as one space, trimmed."""
    bodies = F.array_join(F.transform(strict_blocks(c), lambda b: b["body"]), "")
    return T.strip(T.one_space(F.when(F.size(strict_blocks(c)) > 0, bodies).otherwise(_col(c))))


def packet_hash(c: Column | str) -> Column:
    return T.body_hash(normalized_body(c))


def recipe_digest(transport: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(transport), r"recipe ([0-9a-f]{12})", 1), F.lit(""))


def slug(raw: Column | str, path: Column | str) -> Column:
    """The packet's key: its header's, else its file name's."""
    head = F.regexp_extract(header_part(raw), r"(?mi)^(?:STATE|SLUG):\s*([a-z0-9-]+)\s*$", 1)
    name = F.regexp_extract(_col(path), r"([a-z][a-z-]*?)(?:-\d{4}-\d{2}-\d{2}.*)?\.txt$", 1)
    return F.coalesce(F.nullif(head, F.lit("")), F.nullif(name, F.lit("")))


def archival(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 4000).rlike(r"(?mi)^CLASS:\s*archival\b")


def parts_of(path: Column | str) -> Column:
    """struct(slug, kind) of a packet file name slug[-kind].txt: kind is main, a supplement's name, or a language."""
    base = F.regexp_extract(_col(path), r"([^/]+)\.txt$", 1)
    return F.struct(F.regexp_extract(base, r"^([a-z]+)", 1).alias("slug"), F.coalesce(F.nullif(F.regexp_extract(base, r"^[a-z]+-(.+)$", 1), F.lit("")), F.lit("main")).alias("kind"))


def render(rows: DataFrame, key: str, assembled: str, canary: str = "Captured text follows.") -> DataFrame:
    """(key, packet): sources(key, n, title, url, source_date, retrieved, body) as one text per key, in order of n."""
    said = F.coalesce(F.col("source_date"), F.lit("none published"))
    head = F.concat(F.lit("SOURCE "), F.col("n").cast("string"), F.lit(": "), "title", F.lit(" | "), "url", F.lit(" | source date: "), said, F.lit(" | retrieved: "), "retrieved")
    block = F.concat(head, F.lit("\n"), "body", F.lit("\nEND SOURCE "), F.col("n").cast("string"), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct("n", block.alias("x"))))
    top = F.concat(F.lit(canary + "\nSTATE: "), F.col(key).cast("string"), F.lit(f"\nASSEMBLED: {assembled}\nCAPTURE NOTES:\n"))
    return rows.groupBy(key).agg(ordered.alias("o")).select(key, F.concat(top, F.array_join(F.transform("o", lambda x: x["x"]), "")).alias("packet"))


def joined_pages(rows: DataFrame, key: str, pos: str, url: str, body: str) -> DataFrame:
    """(key, body): a source fetched as several pages, one after another under marker lines, in declared order."""
    ordered = F.array_sort(F.collect_list(F.struct(pos, F.concat(F.lit("--- "), F.col(url), F.lit(" ---\n"), F.col(body)).alias("x"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["x"]), "\n").alias("body"))


def page_sections(pages: DataFrame, key: str = "slug", raw: str = "raw") -> DataFrame:
    """(key, section, heading, pos, line) of Markdown pages: lines with the running number of their ## section, 0 before the first.

    A page is cut at its headings first and a section at its line ends, so that work is linear in the page.
    """
    parts = F.split(raw, r"(?m)(?d)^(?=## )", -1)
    opens = F.startswith(F.col(raw), F.lit("## ")).cast("int")
    heading = lambda p: F.when(p.startswith("## "), F.substr(F.get(F.split(p, "\n", 2), 0), F.lit(4))).otherwise("")
    row = lambda p, i, x: F.struct((i + opens).alias("section"), heading(p).alias("heading"), x.alias("line"))
    rows = F.flatten(T.let(parts, lambda v: F.transform(v, lambda p, i: F.transform(T.lines(F.when(i < F.size(v) - 1, F.substr(p, F.lit(1), F.length(p) - 1)).otherwise(p)), lambda x: row(p, i, x)))))
    return pages.select(key, F.posexplode(rows).alias("pos", "l")).select(key, "l.section", "l.heading", "pos", "l.line")


def docket(pages: DataFrame, key: str = "slug", raw: str = "raw") -> DataFrame:
    """(key, field, value) of lines "**field.** value"."""
    found = F.regexp_extract_all(raw, F.lit(r"(?m)^\*\*([^*]+?)\.\*\*\s*(.*)$"), F.lit(0))
    return pages.select(key, F.explode(found).alias("x")).select(key, F.regexp_extract("x", r"^\*\*([^*]+?)\.\*\*", 1).alias("field"), F.regexp_extract("x", r"^\*\*[^*]+?\.\*\*\s*(.*)$", 1).alias("value"))

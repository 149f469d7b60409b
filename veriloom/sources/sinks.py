"""Writers and what they write: manifest rows, anchor entries, ledgers, reports, and guarded edits of pages."""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.functions import dates as D
from veriloom.functions import text as T
from veriloom.sources.html import canonical_digest


def append_rows(rows: DataFrame, path: str, by: str = "slug") -> None:
    """Append JSON lines below <path>/<by>=..., fields in order of name, nulls left out."""
    fields = sorted(c for c in rows.columns if c != by)
    rows.select(by, *fields).write.mode("append").partitionBy(by).json(path)


def overwrite_current(rows: DataFrame, path: str) -> None:
    """Replace the current table."""
    rows.write.mode("overwrite").parquet(path)


def ledger_json(ledger: DataFrame, key: str = "url") -> DataFrame:
    """One row, one JSON object of key to record, by key: a ledger of a site's links, which is a bounded table."""
    fields = sorted(c for c in ledger.columns if c != key)
    line = F.concat(F.to_json(F.struct(F.col(key).alias("k"))), F.lit(""))
    name = F.regexp_extract(line, r'^\{"k":(.*)\}$', 1)
    entry = F.concat(name, F.lit(":"), F.to_json(F.struct(*fields)))
    ordered = F.array_sort(F.collect_list(F.struct(key, entry.alias("e"))))
    return ledger.agg(F.concat(F.lit('{"sources":{'), F.array_join(F.transform(ordered, lambda x: x["e"]), ","), F.lit("}}")).alias("json"))


def anchor_entry(files: DataFrame, prev: str | None, run: str, utc: str, repo: str, paths: list[str], note: str | None = None) -> DataFrame:
    """One row (manifest, entry, entry_sha256): the sha256 lines of files(path, content) in order of path, and the chain entry over them."""
    lines = F.array_sort(F.collect_list(F.struct("path", F.concat(F.sha2("content", 256), F.lit("  "), "path").alias("x"))))
    one = files.agg(F.array_join(F.transform(lines, lambda x: F.concat(x["x"], F.lit("\n"))), "").alias("manifest"), F.count("*").alias("n"))
    fields = [
        F.lit(run).alias("id"), F.lit(utc).alias("utc"), F.lit(repo).alias("repo"), F.array(*[F.lit(p) for p in paths]).alias("paths"), F.col("n").alias("file_count"),
        F.lit(f"manifests/{run}.txt").alias("manifest_file"), F.sha2(F.col("manifest"), 256).alias("manifest_sha256"), F.lit(prev).cast("string").alias("prev_entry_sha256"),
    ]
    if note:
        fields.append(F.lit(note).alias("note"))
    entry = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return one.select("manifest", entry.alias("entry")).withColumn("entry_sha256", canonical_digest(F.col("entry")))


def redirects(paths: DataFrame) -> DataFrame:
    """(line) "old new 301" of every other address of pages(path), in order."""
    from veriloom.operators.coverage import canonical_path, other_paths

    return paths.select(F.explode(other_paths(F.col("path"))).alias("old"), canonical_path(F.col("path")).alias("new")).select(F.concat_ws(" ", "old", "new", F.lit("301")).alias("line")).orderBy("line")


def inject(page: Column, name: str, block: Column) -> Column:
    """A page with what stands between <!-- name:BEGIN --> and <!-- name:END --> replaced; fails if it lacks the markers."""
    a, b = f"<!-- {name}:BEGIN -->", f"<!-- {name}:END -->"
    both = (F.instr(page, a) > 0) & (F.instr(page, b) > F.instr(page, a))
    new = F.concat(F.substring_index(page, a, 1), F.lit(a + "\n"), block, F.lit("\n" + b), F.substr(page, F.instr(page, b) + len(b)))
    return F.when(both, new).otherwise(F.raise_error(F.lit(f"no markers for {name}")))


def insert_after(page: Column, heading: str, entry: Column) -> Column:
    """A page with an entry under a heading that occurs once; null if it doesn't."""
    n = (F.length(page) - F.length(F.replace(page, F.lit(heading), F.lit("")))) / len(heading)
    return F.when(n == 1, F.replace(page, F.lit(heading), F.concat(F.lit(heading), entry, F.lit("\n\n"))))


def corrections(told: DataFrame, derived: DataFrame, key: str = "slug", value: str = "checked") -> DataFrame:
    """(surface, slug, was, now): dates that surfaces derive from a key's own and have wrong. Missing rows are not made up."""
    return derived.join(told.select(key, F.col(value).alias("now")), key).where(~F.col(value).eqNullSafe(F.col("now"))).select("surface", key, F.col(value).alias("was"), "now")


def checked_dates(pages: DataFrame, index: DataFrame, home: DataFrame) -> DataFrame:
    """(surface, slug, checked): dates of Markdown sources and rendered pages(slug, md, html), of the index's table rows and of the home page's records."""
    from veriloom.sources.files import island_records

    # How these pages write their dates.
    md = F.nullif(F.regexp_extract("md", r"\*\*Sources last checked\.\*\*\s*(.+)", 1), F.lit(""))
    html = F.nullif(F.regexp_extract("html", r'class="docket-checked">([^<]+)<', 1), F.lit(""))
    row = r'(?s)<tr><td><a href="(?:/states/)?([a-z\-]+)(?:\.html|/)">.*?</td><td>([^<]*)</td></tr>'
    # End of fixed values.
    rows = index.select(F.explode(F.regexp_extract_all("html", F.lit(row), F.lit(0))).alias("x"))
    parts = [
        pages.where(md.isNotNull()).select(F.lit("source").alias("surface"), "slug", D.display(T.strip(md)).alias("checked")),
        pages.where(html.isNotNull()).select(F.lit("page").alias("surface"), "slug", T.strip(html).alias("checked")),
        rows.select(F.lit("table").alias("surface"), F.regexp_extract("x", row, 1).alias("slug"), T.strip(F.regexp_extract("x", row, 2)).alias("checked")),
        island_records(home, "state-index", "slug string, checked string").select(F.lit("json").alias("surface"), "slug", "checked"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_name(page: Column, url: Column) -> Column:
    """What a page calls a source: the first descriptive text of links to it, else its first text, else the address without scheme."""
    link = F.concat(F.lit(r'(?s)<a href="\Q'), T.html_escape(url), F.lit(r'\E"[^>]*>(.*?)</a>'))
    texts = F.transform(F.regexp_extract_all(page, link, F.lit(1)), lambda x: T.strip(T.html_unescape(F.regexp_replace(x, "<[^>]+>", ""))))
    bare = F.regexp_replace(url, r"^https?://(www\.)?", "")
    host = F.substring_index(bare, "/", 1)
    plain = lambda n: (n == bare) | F.startswith(n, F.concat(host, F.lit(" "))) | F.startswith(n, F.concat(host, F.lit("/")))
    return T.let(F.filter(texts, lambda n: n != ""), lambda names: F.coalesce(F.get(F.filter(names, lambda n: ~plain(n)), 0), F.get(names, 0), bare))


def slice_note(spec: Column) -> Column:
    """How a slice(from, to, from_occurrence, to_occurrence) is described."""
    nth = lambda f: F.when(F.coalesce(spec[f], F.lit(1)) != 1, F.concat(F.lit(" (occurrence "), spec[f].cast("string"), F.lit(")"))).otherwise("")
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    end = F.when(F.coalesce(spec["to"], F.lit("")) != "", F.concat(quoted(spec["to"]), nth("to_occurrence"))).otherwise("the end of the document")
    return F.concat(F.lit("slice from "), quoted(spec["from"]), nth("from_occurrence"), F.lit(" to "), end)


def range_text(dates: Column, today: Column) -> Column:
    """When captures were requested: this date, another, or a range."""
    lo, hi = F.array_min(dates), F.array_max(dates)
    return F.when((lo == hi) & (lo == today), "this date").when(lo == hi, F.concat(F.lit("on "), lo)).otherwise(F.concat(F.lit("between "), lo, F.lit(" and "), hi))


def needed_links(pages: DataFrame, archived: tuple[str, ...] = ("web.archive.org",), key: str = "slug", html: str = "html") -> DataFrame:
    """(slug, url): external links of pages that have no capture link on the page."""
    links = pages.select(key, F.explode(C.external_links(html)).alias("url"))
    is_capture = C.bare_host("url").isin(*archived)
    captured = links.where(is_capture).select(key, F.regexp_extract("url", r"^https?://[^/]+/web/[^/]+/(.+)$", 1).alias("url"))
    return links.where(~is_capture).join(captured, [key, "url"], "left_anti")


def report(findings: DataFrame, attendance: DataFrame, start: str, end: str) -> DataFrame:
    """One row, one JSON text of a window's digest: at most a few findings a key and month."""
    f = findings.agg(F.array_sort(F.collect_list(F.struct(*findings.columns))).alias("findings"))
    a = attendance.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("result", "passes")))).alias("attendance"), F.coalesce(F.sum("passes"), F.lit(0)).alias("passes"))
    window = F.struct(F.lit(start).alias("from"), F.lit(end).alias("to")).alias("window")
    return f.crossJoin(a).select(F.to_json(F.struct(window, "attendance", "passes", "findings")).alias("json"))


def report_text(findings: DataFrame, attendance: DataFrame, start: str, end: str) -> DataFrame:
    """One row, one text of a window's digest: what was done, and each of findings(slug, kind, date, supersedes, capture, verdicts, publishable), which
    are a few a month, candidates first, then what only concerns tools."""
    said = F.concat(F.lit("  "), "date", F.lit("  "), "slug", F.lit(" ("), "kind", F.lit(")  "))
    line = F.when(F.col("publishable"), F.concat(said, F.coalesce("supersedes", F.lit("none")), F.lit(" -> "), "capture", F.lit("\n    "), F.array_join("verdicts", "; "))).otherwise(F.concat(said, F.array_join("verdicts", "; ")))
    rows = F.array_sort(F.collect_list(F.struct("date", "slug", "kind", "publishable", line.alias("x"))))
    f = findings.agg(rows.alias("f"))
    passes = F.array_sort(F.collect_list(F.struct("result", "passes")))
    a = attendance.agg(F.coalesce(F.sum("passes"), F.lit(0)).alias("n"), F.array_join(F.transform(passes, lambda x: F.concat(x["result"], F.lit(" "), x["passes"].cast("string"))), ", ").alias("by"))
    part = lambda on: F.transform(F.filter("f", lambda x: x["publishable"] == on), lambda x: x["x"])
    listed = lambda on: F.when(F.size(part(on)) > 0, F.array_join(part(on), "\n")).otherwise("  none")
    text = F.concat(
        F.lit(f"Changes from {start} to {end}\n"), F.col("n").cast("string"), F.lit(" pass(es): "), "by", F.lit("\n\nCandidates ("), F.size(part(True)).cast("string"), F.lit(")\n"), listed(True),
        F.lit("\n\nTooling, not news ("), F.size(part(False)).cast("string"), F.lit(")\n"), listed(False), F.lit("\n"),
    )
    return f.crossJoin(a).select(text.alias("text"))


def report_draft(findings: DataFrame, attendance: DataFrame, start: str, end: str) -> DataFrame:
    """One row, one Markdown draft of a window's published change record: a line to be written for each candidate."""
    line = F.concat(F.lit("- **"), "slug", F.lit("** ("), "date", F.lit(") — "), F.array_join("verdicts", "; "), F.lit(". TODO: what changed, in the words of "), F.coalesce("supersedes", F.lit("none")), F.lit(" and "), "capture", F.lit("."))
    f = findings.where("publishable").agg(F.array_sort(F.collect_list(F.struct("date", "slug", "kind", line.alias("x")))).alias("f"))
    tools = findings.where("not publishable").agg(F.array_join(F.array_sort(F.collect_set("slug")), ", ").alias("t"), F.count("*").alias("n"))
    same = attendance.agg(F.coalesce(F.sum(F.when(F.col("result") == "confirmed", F.col("passes"))), F.lit(0)).alias("same"))
    none = F.concat(F.lit("Nothing moved; "), F.col("same").cast("string"), F.lit(" pass(es) found the sources unchanged."))
    text = F.concat(
        F.lit(f"# Change record, {start} to {end}\n\n## What moved\n\n"), F.when(F.size("f") > 0, F.array_join(F.transform("f", lambda x: x["x"]), "\n")).otherwise(none),
        F.lit("\n\n## Corrections\n\nTODO\n\n## Tooling notes\n\n"), F.col("n").cast("string"), F.lit(" drift(s) came from extraction or filters: "), F.when(F.col("t") != "", F.col("t")).otherwise("none"), F.lit(".\n"),
    )
    return f.crossJoin(tools).crossJoin(same).select(text.alias("text"))


def status_table(rows: DataFrame) -> DataFrame:
    """One row, one Markdown table of rows(name, base, full, checked): a dimension's few members, by name, under their counts."""
    box = lambda c: F.when(F.col(c), "[x]").otherwise("[ ]")
    line = F.concat(F.lit("| "), "name", F.lit(" | "), box("base"), F.lit(" | "), box("full"), F.lit(" | "), F.coalesce("checked", F.lit("")), F.lit(" |"))
    agg = rows.agg(F.array_sort(F.collect_list(F.struct("name", line.alias("x")))).alias("r"), F.count("*").alias("n"), F.count_if(F.col("base")).alias("b"), F.count_if(F.col("full")).alias("f"))
    head = F.format_string("**Baseline: %d of %d · Full: %d of %d**\n\n| Name | Baseline | Full | Last checked |\n|---|:---:|:---:|---|\n", "b", "n", "f", "n")
    return agg.select(F.concat(head, F.array_join(F.transform("r", lambda x: x["x"]), "\n"), F.lit("\n")).alias("text"))


def filled(form: str, **values: Column) -> Column:
    """A form whose {names} are replaced by columns."""
    parts = re.split(r"\{(\w+)\}", form)
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def picker(rows: DataFrame, block: str, link: str, awaited: str, dated: str) -> DataFrame:
    """One row, one block of links to the pages of rows(name, slug, abbr, published, checked), a dimension's few members, by name; those not published aren't links.

    The forms are a site's own: block holds {links}, one a line; link {slug}, {title}, {abbr} and {name}, its title a name and, where it is known, dated with
    {checked}; awaited {abbr} and {name}.
    """
    name = T.html_escape(F.col("name"))
    title = F.concat(name, F.coalesce(filled(dated, checked=T.html_escape(F.col("checked"))), F.lit("")))
    known = {"slug": F.col("slug"), "title": title, "abbr": F.col("abbr"), "name": name}
    one = F.when(F.col("published"), filled(link, **known)).otherwise(filled(awaited, **known))
    ordered = F.array_sort(F.collect_list(F.struct("name", one.alias("x"))))
    return rows.agg(filled(block, links=F.array_join(F.transform(ordered, lambda x: x["x"]), "\n")).alias("html"))



def method_digest(recipe: Column) -> Column:
    """12 digits over a recipe's JSON that its captured text depends on: titles and notes don't, and options count only if set."""
    always = ("n", "url", "transport", "extractor", "scope")
    if_true = ("urls", "http_version", "encoding", "drop_icon_space", "drop_sr_only", "ca_bundle", "pages", "slice")

    def one(text: str) -> str:
        material = []
        for s in json.loads(text)["sources"]:
            m = {k: s.get(k) for k in always} | {"filters": s.get("filters") or []} | {k: s[k] for k in if_true if s.get(k)}
            if (s.get("user_agent") or "none") != "none":
                m["user_agent"] = s["user_agent"]
            if s.get("compressed") is False:
                m["compressed"] = False
            material.append(m)
        blob = json.dumps({"v": 1, "sources": material}, sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(blob.encode()).hexdigest()[:12]

    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else one(x))

    return run(recipe)


def transport(declared: Column, given: Column) -> Column:
    """struct(transport, error): what to record of a capture that declares a recipe digest (or none) and an operator's note.

    A note that names another digest is refused, as is one that speaks of a recipe where none is declared; a missing
    reference is added.
    """
    claimed = F.regexp_extract_all(F.coalesce(given, F.lit("")), F.lit(r"recipe ([0-9a-f]{12})"), F.lit(1))
    ref = F.concat(F.lit("recipe "), declared)
    wrong = F.get(F.filter(claimed, lambda d: d != declared), 0)
    bare = declared.isNull() & F.coalesce(given, F.lit("")).rlike(r"(?i)\brecipe\b")
    error = F.when(declared.isNotNull() & wrong.isNotNull(), F.concat(F.lit("names digest "), wrong, F.lit(" but the capture declares "), declared)).when(bare, "claims a recipe that the capture doesn't declare")
    said = F.when(declared.isNull(), given).when(F.coalesce(given, F.lit("")) == "", ref).when(F.array_contains(claimed, declared), given).otherwise(F.concat(given, F.lit(", "), ref))
    return F.struct(F.when(error.isNull(), said).alias("transport"), error.alias("error"))

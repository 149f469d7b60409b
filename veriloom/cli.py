"""python -m veriloom.cli COMMAND ...: the operators as commands over folders of files.

Exit codes: 0 nothing is wrong, 1 something is, 2 the command can't be carried out (files missing or malformed arguments).
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from glob import glob

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.operators import compare, coverage, fidelity, gates, health, history, queue, worker
from veriloom.sources import files, packets, sinks
from veriloom.sources.html import canonical_digest

Say = Callable[[str], None]


def _name(path: str = "path"):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^/.]+)*$", 1)


def _texts(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return packets.files(spark, path, glob)


def _tell(rows: DataFrame, say: Say) -> int:
    """Print rows, which are what is wrong, in order; how many there are."""
    n = 0
    for r in rows.orderBy(*rows.columns).toLocalIterator():
        say("  ".join("" if v is None else str(v) for v in r))
        n += 1
    return n


def _pages(spark: SparkSession, path: str, lang: str) -> DataFrame:
    mine = _texts(spark, path, "*.{html,md}").withColumn("stem", F.regexp_extract("path", r"([^/]+)\.(?:html|md)$", 1))
    other = F.regexp_extract("stem", r"\.([a-z]{2})$", 1)
    mine = mine.where(other == ("" if lang == "en" else lang))
    return mine.select(F.regexp_replace("stem", r"\.[a-z]{2}$", "").alias("slug"), F.lit(lang).alias("lang"), "raw")


def _packets_of(spark: SparkSession, path: str, lang: str) -> DataFrame:
    known = _texts(spark, path, "*.txt")
    return health.packet_set(known, lang).join(known, "path").select("slug", "path", F.col("raw").alias("body"))


def _findings(spark: SparkSession, a) -> tuple[DataFrame, DataFrame]:
    pages = _pages(spark, a.pages, a.lang)
    index = fidelity.quote_index(spark.read.text(a.index)) if a.index else None
    return pages, fidelity.check(pages, _packets_of(spark, a.packets, a.lang), index)


def lint(spark: SparkSession, a, say: Say) -> int:
    """Everything that is wrong with recipes."""
    return int(_tell(files.lint(files.recipes(spark, a.recipes), options=True), say) > 0)


def fidelity_(spark: SparkSession, a, say: Say) -> int:
    """What pages say that their packets don't."""
    return int(_tell(_findings(spark, a)[1], say) > 0)


def check_all(spark: SparkSession, a, say: Say) -> int:
    """Totals of a whole check; what exempt slugs fail counts under --strict only."""
    pages, found = _findings(spark, a)
    exempt = spark.createDataFrame([(s,) for s in a.exempt], "slug string")
    if not a.quiet:
        _tell(found, say)
    r = coverage.run_totals(pages, found, exempt, "slug", a.strict).first()
    say(f"{r.pages} page(s): {r.clean} clean, {r.soft} soft, {r.hard} hard")
    return int(not r.passed)


def packet_set(spark: SparkSession, a, say: Say) -> int:
    """Packets by slug and kind."""
    return int(_tell(health.packet_set(_texts(spark, a.packets, "*.txt"), a.lang).select("slug", "kind", "path"), say) == 0)


def retain(spark: SparkSession, a, say: Say) -> int:
    """Verify that stored captures are there and have the hashes that manifests tell."""
    held = _texts(spark, a.history, "*.txt").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("slug"), F.substring_index("path", "/", -1).alias("capture"), packets.packet_hash("raw").alias("hash"))
    rows = files.manifest(spark, a.history)
    if a.log:
        _tell(rows.select("slug", "seq", "date", "result", "capture"), say)
    return int(_tell(history.verify_store(rows, held), say) > 0)


def digest(spark: SparkSession, a, say: Say) -> int:
    """What drifted in a window of days: candidates and what only concerns tools; 1 if captures are missing."""
    rows = files.manifest(spark, a.history).where(f"'{a.slug or ''}' in ('', slug)")
    held = _texts(spark, a.history, "*.txt").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("slug"), F.substring_index("path", "/", -1).alias("capture"), "raw")
    pairs = history.drift_pairs(rows, a.start, a.end)
    side = lambda c: packets.sources(pairs.select("slug", "kind", "date", F.col(c).alias("capture")).join(held, ["slug", "capture"]), keep=["slug", "kind", "date"])
    classified = compare.classify(side("supersedes"), side("capture"), ["slug", "kind", "date", "n"])
    one = compare.verdict_sets(classified.withColumn("key", F.struct("slug", "kind", "date")), "key").select("key.*", "verdicts", "publishable")
    found = pairs.join(one, ["slug", "kind", "date"], "left").select("slug", "kind", "date", "supersedes", "capture", F.coalesce("verdicts", F.array()).alias("verdicts"), F.coalesce("publishable", F.lit(False)).alias("publishable"))
    seen = history.attendance(rows, a.start, a.end)
    if a.json:
        say(sinks.report(found, seen, a.start, a.end).first()[0])
    else:
        say((sinks.report_draft if a.draft else sinks.report_text)(found, seen, a.start, a.end).first()[0])
    missing = pairs.select("slug", F.explode(F.array("capture", "supersedes")).alias("capture")).where("capture is not null").join(held, ["slug", "capture"], "left_anti")
    return int(_tell(missing.distinct(), say) > 0)


def health_(spark: SparkSession, a, say: Say) -> int:
    """Everything that is wrong with a rotation; 1 if any of it is severe."""
    rows = files.manifest(spark, a.history)
    last = history.latest(rows, ["slug"]).select("slug", "date")
    known = _texts(spark, a.packets, "*-packet-*.txt").select("path", _name().alias("stem"), F.substring("raw", 1, 4000).alias("head"))
    recipes = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(a.recipes).select(_name().alias("stem"))
    led = files.ledger(spark.read.text(a.ledger, wholetext=True)) if a.ledger else spark.createDataFrame([], "url string, last_detail string, last_result string")
    cursor = open(a.cursor, encoding="utf-8").read().strip() if a.cursor else None
    found = health.report(last, F.to_date(F.lit(a.today)), last.select("slug"), cursor, a.cursor is not None, known, recipes, led, list(health.ACCOUNT_FAULTS))
    _tell(found, say)
    return int(not health.healthy(found))


def anchor(spark: SparkSession, a, say: Say) -> int:
    """Verify a tree against a manifest of digests."""
    tree = files.walk(spark, a.tree).select(F.regexp_replace("path", "^(?:file:)?/*", "/").alias("path"), F.sha2("content", 256).alias("sha256"))
    root = "/" + a.tree.strip("/") + "/"
    tree = tree.withColumn("path", F.expr(f"substring(path, {len(root) + 1})"))
    return int(_tell(history.manifest_status(history.manifest_lines(spark.read.text(a.manifest)), tree), say) > 0)


def retain_result(spark: SparkSession, a, say: Say) -> int:
    """Retain the packets of a folder with a result of today: new captures are stored, unchanged ones named, and a line is appended to each manifest.

    What is already the last line of a slug and kind is not recorded again, so that a second run writes nothing.
    """
    if a.result not in files.RESULTS:
        say(f"unknown result: {a.result}")
        return 2
    part = packets.parts_of(F.col("path"))
    found = _texts(spark, a.packets, "*.txt").select(
        part["slug"].alias("slug"), F.regexp_replace(part["kind"], "^packet$", "main").alias("kind"), F.lit(a.date).alias("date"), F.lit(a.result).alias("result"),
        packets.packet_hash("raw").alias("hash"), packets.headers("raw").alias("headers"), packets.urls("raw").alias("urls"), F.col("raw"),
    )
    known = files.manifest(spark, a.history) if glob(os.path.join(a.history, "*", "manifest.jsonl")) else spark.createDataFrame([], f"slug string, seq int, {files.MANIFEST}")
    last = history.latest(known.withColumn("kind", F.coalesce("kind", F.lit("main"))), ["slug", "kind"]).select("slug", "kind", "date", "result", "hash")
    new = found.join(last, ["slug", "kind", "date", "result", "hash"], "left_anti")
    made = history.retain(new.select("slug", "kind", "date", "result", "hash", "headers"), known).join(new.select("slug", "kind", "urls", "raw"), ["slug", "kind"])
    n = 0
    for r in made.orderBy("slug", "kind").toLocalIterator():  # packets of one run: a file each
        folder = os.path.join(a.history, r.slug)
        os.makedirs(folder, exist_ok=True)
        if r.stored:
            with open(os.path.join(folder, r.capture), "x", encoding="utf-8") as f:
                f.write(r.raw)
        row = {"date": r.date, "result": r.result, "kind": r.kind, "hash": r.hash, "sources": len(r.headers), "urls": r.urls, "headers": r.headers, "capture": r.capture, "stored": r.stored, "supersedes": r.supersedes}
        if r.headers_gone is not None:
            row["header_changes"] = {"gone": r.headers_gone, "new": r.headers_new}
        with open(os.path.join(folder, "manifest.jsonl"), "a", encoding="utf-8") as f:
            f.write(json.dumps({k: v for k, v in sorted(row.items()) if v is not None}, ensure_ascii=False) + "\n")
        say(f"{r.slug}  {r.kind}  {r.capture}  {'stored' if r.stored else 'unchanged'}")
        n += 1
    say(f"{n} recorded")
    return 0


def anchor_run(spark: SparkSession, a, say: Say) -> int:
    """Anchor a tree: its digests as a manifest, and an entry that names the digest of the entry before. The chain is verified first; 1 if it is broken."""
    entries = []
    for path in sorted(glob(os.path.join(a.anchors, "entries", "*.json"))):  # an entry a run
        with open(path, encoding="utf-8") as f:
            entries.append(json.load(f))
    if entries:
        told = spark.createDataFrame([(e["id"], json.dumps({k: v for k, v in e.items() if k != "entry_sha256"}), e["entry_sha256"], e["prev_entry_sha256"]) for e in entries], "id string, entry string, entry_sha256 string, prev_entry_sha256 string")
        bad = told.where(canonical_digest(F.col("entry")) != F.col("entry_sha256")).select("id").unionByName(history.chain_breaks(told).select("id")).distinct()
        if _tell(bad, say):
            return 1
    if any(e["id"] >= a.run_id for e in entries):
        say(f"a run must come after {entries[-1]['id']}")
        return 2
    root = "/" + a.tree.strip("/") + "/"
    tree = files.walk(spark, a.tree).select(F.regexp_replace("path", "^(?:file:)?/*", "/").alias("path"), "content").withColumn("path", F.expr(f"substring(path, {len(root) + 1})"))
    made = sinks.anchor_entry(tree, entries[-1]["entry_sha256"] if entries else None, a.run_id, a.utc, a.repo, [a.tree], a.note).first()
    for folder in ("manifests", "entries"):
        os.makedirs(os.path.join(a.anchors, folder), exist_ok=True)
    with open(os.path.join(a.anchors, "manifests", f"{a.run_id}.txt"), "x", encoding="utf-8") as f:
        f.write(made.manifest)
    with open(os.path.join(a.anchors, "entries", f"{a.run_id}.json"), "x", encoding="utf-8") as f:
        json.dump(json.loads(made.entry) | {"entry_sha256": made.entry_sha256}, f, indent=1, sort_keys=True)
    say(f"{a.run_id}  {made.entry_sha256}")
    return 0


def dates(spark: SparkSession, a, say: Say) -> int:
    """Dates that rendered pages, the index and the home page's records derive from Markdown sources and have wrong; 1 if any is."""
    stem = F.regexp_extract("path", r"([^/]+)\.(?:html|md)$", 1).alias("slug")
    md = _texts(spark, a.sources, "*.md").select(stem, F.col("raw").alias("md"))
    html = _texts(spark, a.pages, "*.html").select(stem, F.col("raw").alias("html"))
    one = lambda path: spark.read.text(path, wholetext=True).select(F.col("value").alias("html"))
    found = sinks.checked_dates(md.join(html, "slug", "full_outer"), one(a.index_page), one(a.home))
    return int(_tell(sinks.corrections(found.where("surface = 'source'"), found.where("surface <> 'source'")), say) > 0)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger's rows; none if there is no file yet."""
    text = spark.read.text(path, wholetext=True) if os.path.exists(path) else spark.createDataFrame([], "value string")
    return files.ledger(text)


def _keep(ledger: DataFrame, path: str) -> None:
    """Write a ledger in place of the one before, whole or not at all."""
    text = sinks.ledger_json(ledger).first()[0]
    with open(path + ".new", "w", encoding="utf-8") as f:
        f.write(text + "\n")
    os.replace(path + ".new", path)


def _wanted(spark: SparkSession, a) -> DataFrame:
    return sinks.needed_links(_pages(spark, a.pages, "en").select("slug", F.col("raw").alias("html")))


def status(spark: SparkSession, a, say: Say) -> int:
    """How a retry queue stands: candidates are the pages' external links without a capture."""
    led = _ledger(spark, a.ledger).withColumn("last_attempt", worker.when("last_attempt"))
    _tell(queue.totals(queue.queue(_wanted(spark, a), led, F.to_timestamp(F.lit(a.now))), ["slug"]), say)
    return 0


def _planned(spark: SparkSession, a) -> DataFrame:
    return worker.plan(_wanted(spark, a), _ledger(spark, a.ledger), F.to_timestamp(F.lit(a.now)), int(a.budget), int(a.most) if a.most else None, a.retry_blocked)


def plan(spark: SparkSession, a, say: Say) -> int:
    """What a run for so many captures would attempt, in order, and what is held back and why."""
    for r in _planned(spark, a).orderBy(F.col("place").isNull(), "place", "part", "slug", "url").toLocalIterator():
        say("  ".join(str(v) for v in (r.part, r.slug, r.last_detail, r.url) if v is not None))
    return 0


def run(spark: SparkSession, a, say: Say) -> int:
    """Note in the ledger what a run attempted, by the recorded answers of the far side (JSON lines); 1 if an account fault ended it."""
    answers = spark.read.schema("url string, at string, result string, detail string, message string, capture string").json(a.answers)
    made = worker.run(_planned(spark, a), answers.where("url is not null"), int(a.budget), int(a.most) if a.most else None)
    stored = tried = fault = 0
    for r in made.orderBy("seq").toLocalIterator():  # a run's attempts, bounded by its budget
        tried, stored, fault = tried + 1, stored + (r.result == "PENDING"), fault or (r.detail in worker.ACCOUNT)
        say(f"{r.result}  {r.page}  {r.detail or ''}  {r.url}")
    if tried:
        _keep(worker.noted(_ledger(spark, a.ledger), made), a.ledger)
    say(f"{stored} stored, {tried} attempted")
    return int(bool(fault))


def confirm(spark: SparkSession, a, say: Say) -> int:
    """Note in the ledger which pending captures were read back, by recorded looks (JSON lines), until one was throttled."""
    led, now = _ledger(spark, a.ledger), F.to_timestamp(F.lit(a.now))
    looks = spark.read.schema("url string, seen string").json(a.looks)
    found = worker.looked(led, looks.where("url is not null"), now)
    _tell(found.select("outcome", "page", "url"), say)
    _keep(worker.confirmed(led, found, F.date_format(now, "yyyy-MM-dd'T'HHmmss'Z'")), a.ledger)
    return 0


def record(spark: SparkSession, a, say: Say) -> int:
    """Enter confirmed captures that pages don't link yet in the logs of their Markdown sources; 1 if some must be entered by hand."""
    html = _texts(spark, a.pages, "*.html").select(_name().alias("slug"), F.col("raw").alias("html"))
    md = _texts(spark, a.sources, "*.md").select(_name().alias("slug"), F.col("raw").alias("md"), "path")
    done = worker.recorded(html.join(md.drop("path"), "slug", "left"), _ledger(spark, a.ledger), a.today, a.heading.rstrip("\n") + "\n\n", a.entry)
    missed = 0
    for r in done.orderBy("slug").toLocalIterator():  # pages with something to record
        missed += r.reason is not None
        say(f"{'skipped' if r.reason else 'would record' if a.dry_run else 'recorded'}  {r.slug}  {r.reason or str(r.captures) + ' capture(s)'}")
        if not r.reason and not a.dry_run:
            path = os.path.join(a.sources, f"{r.slug}.md")
            with open(path + ".new", "w", encoding="utf-8", newline="") as f:
                f.write(r.md)
            os.replace(path + ".new", path)
    return int(missed > 0)


def live(spark: SparkSession, a, say: Say) -> int:
    """What copies of published pages load from hosts that aren't the site's own."""
    pages = _texts(spark, a.pages, "*.html").select(_name().alias("slug"), "raw")
    return int(_tell(pages.select("slug", F.explode(gates.loads(F.col("raw"), a.own)).alias("load")).distinct(), say) > 0)


def sitemap(spark: SparkSession, a, say: Say) -> int:
    """A site's sitemap; with --check, 1 if the file differs from it."""
    root = "/" + a.site.strip("/") + "/"
    pages = _texts(spark, a.site, "*.html").select(F.expr(f"substring(regexp_replace(path, '^(file:)?/*', '/'), {len(root) + 1})").alias("path"), "raw", F.col("raw").alias("html"))
    kept = coverage.sitemap(pages, a.exclude, pages.limit(0)).where("reason is null").join(pages.select("path", "raw"), "path")
    dated = kept.select("path", F.coalesce(F.nullif(F.regexp_extract("raw", r'datetime="(\d{4}-\d{2}-\d{2})"', 1), F.lit("")), F.lit(a.today)).alias("lastmod"))
    text = coverage.sitemap_xml(dated, a.base).first()[0]
    if not a.check:
        say(text)
        return 0
    same = open(a.check, encoding="utf-8").read() == text
    say("current" if same else f"{a.check} differs from what the pages say")
    return int(not same)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="veriloom", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, f, *args: str, **options) -> None:
        c = sub.add_parser(name, help=f.__doc__)
        for x in args:
            c.add_argument(x)
        for k, v in options.items():
            k = "--" + k.replace("_", "-")
            if isinstance(v, bool):
                c.add_argument(k, action="store_true")
            elif isinstance(v, list):
                c.add_argument(k, nargs="*", default=v)
            else:
                c.add_argument(k, default=v)
        c.set_defaults(run=f)

    page = {"lang": "en", "index": None}
    add("lint", lint, "recipes")
    add("fidelity", fidelity_, "pages", "packets", **page)
    add("check-all", check_all, "pages", "packets", strict=False, quiet=False, exempt=[], **page)
    add("packet-set", packet_set, "packets", lang="en")
    add("retain", retain, "history", log=False)
    add("retain-result", retain_result, "packets", "history", "result", "date")
    add("anchor-run", anchor_run, "tree", "anchors", "run_id", "utc", repo="", note=None)
    add("dates", dates, "sources", "pages", "index_page", "home")
    add("digest", digest, "history", "start", "end", slug=None, json=False, draft=False)
    add("health", health_, "history", "packets", "recipes", "today", cursor=None, ledger=None)
    add("anchor", anchor, "tree", "manifest")
    add("status", status, "pages", "ledger", "now")
    add("plan", plan, "pages", "ledger", "now", "budget", most=None, retry_blocked=False)
    add("run", run, "pages", "ledger", "answers", "now", "budget", most=None, retry_blocked=False)
    add("confirm", confirm, "ledger", "looks", "now")
    add("record", record, "pages", "sources", "ledger", "today", heading="## Change log", entry="{today} — Captures recorded, requested {when}: {items}.", dry_run=False)
    add("live", live, "pages", own=[])
    add("sitemap", sitemap, "site", "base", "today", check=None, exclude=[])
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None, say: Say = print) -> int:
    try:
        a = parser().parse_args(args)
    except SystemExit as e:
        return 2 if e.code else 0
    spark = spark or SparkSession.builder.appName("veriloom").getOrCreate()
    try:
        return a.run(spark, a, say)
    except (AnalysisException, FileNotFoundError) as e:
        say(str(e).splitlines()[0])
        return 2


if __name__ == "__main__":
    sys.exit(main())

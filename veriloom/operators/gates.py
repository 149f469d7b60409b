"""Quality gates: each is the rows that violate it, (gate, page, detail); a gate passes if it has none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.functions import text as T

# What gates look for.
PLACEHOLDER = r"\[named human reviewer|\[pending review before publication|\[reviewer"
PENDING = r"(?i)review[- ]pending"
LOADED = r'(?i)<(?:script|link|img|iframe|source|video|audio|embed|object)\b[^>]*?\b(?:src|href|data)\s*=\s*"([^"]+)"'
CSS_LOADED = r"""(?i)(?:@import\s+|url\()\s*["']?(https?://[^"')\s]+)"""
ROOTED = ("http://", "https://", "//", "/", "#", "mailto:", "tel:", "data:", "javascript:")
LEAKED = r"\[[^\]\n]{2,80}\]\([^)\n]{1,80}\)"
ALLOWED_EXT = "html|css|js|svg|png|ico|jpg|jpeg|gif|webp|avif|woff|woff2|ttf|pdf|txt|md|json|jsonl|xml|webmanifest"
ALLOWED_NAME = "LICENSE|_redirects|_headers|CNAME"
ALWAYS_NAMED = (".assetsignore", ".DS_Store", "wrangler.toml", "predeploy-check.sh")
SKIPPED_FOLDERS = r"(?:^|/)(?:\.wrangler|node_modules|anchors|\.git)/"
ADVICE = ("you should", "we recommend", "your deadline", "be sure to", "you qualify", "we advise", "you need to file")
MUST_IGNORE = ("wrangler.toml", ".assetsignore", ".wrangler", "predeploy-check.sh")
# End of fixed values.


def loads(html: Column, own: list[str]) -> Column:
    """Distinct third-party addresses that a page makes a browser fetch: elements (but navigating links) and style references."""
    kept = T.drop_navigation_links(html)
    refs = F.concat(F.regexp_extract_all(kept, F.lit(LOADED), F.lit(1)), F.regexp_extract_all(html, F.lit(CSS_LOADED), F.lit(1)))
    foreign = lambda r: ~r.startswith("data:") & F.coalesce(~C.bare_host(r).isin(*own) if own else C.bare_host(r).isNotNull(), F.lit(False))
    return F.array_distinct(F.filter(refs, foreign))


def advice(html: Column) -> Column:
    """Phrases of advice outside quotations of either kind, tags out first."""
    bare = F.replace(F.regexp_replace(html, "<[^>]*>", " "), F.lit("&quot;"), F.lit('"'))
    masked = F.lower(F.regexp_replace(F.regexp_replace(bare, "“[^”]*”", ""), '"[^"]*"', ""))
    return F.filter(F.array(*[F.lit(p) for p in ADVICE]), lambda p: F.contains(masked, p))


def relative_refs(html: Column) -> Column:
    """Internal references that don't start at the root."""
    refs = F.regexp_extract_all(html, F.lit(r'\b(?:href|src)="([^"]*)"'), F.lit(1))
    return F.filter(refs, lambda r: (r != "") & ~reduce(lambda a, b: a | b, [r.startswith(p) for p in ROOTED]))


def leaked_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(LEAKED), F.lit(0))


def violations(pages: DataFrame, own_hosts: list[str], required: dict[str, str] | None = None, words: dict[str, str] | None = None, page: str = "path", html: str = "html") -> DataFrame:
    """(gate, page, detail) of all page gates in one scan: the gates are an array per page, exploded once.

    required: gate -> text that every page holds. words: spelling not to be used outside quotations -> the right one.
    """
    h = F.col(html)
    one = lambda gate, details: F.transform(details, lambda d: F.struct(F.lit(gate).alias("gate"), d.alias("detail")))
    said = lambda bad, detail: F.when(bad, F.array(F.lit(detail))).otherwise(F.expr("cast(array() as array<string>)"))
    gates = [
        one("placeholder", said(h.rlike(PLACEHOLDER), "reviewer placeholder")),
        one("pending", said(h.rlike(PENDING), "review pending")),
        one("external", loads(h, own_hosts)),
        one("advice", advice(h)),
        one("relative", relative_refs(h)),
        one("leaked", leaked_links(T.mask_block(h, "<script", "</script>"))),
    ]
    gates += [one(g, said(~F.contains(h, F.lit(need)), "missing")) for g, need in (required or {}).items()]
    gates += [one("spelling", said(T.outside_quotes_html(h, w, "\u0001") != h, w)) for w in (words or {})]
    return pages.select(F.col(page).alias("page"), F.explode(F.concat(*gates)).alias("g")).select("g.gate", "page", "g.detail")


def stray_files(files: DataFrame, ignored: list[str], path: str = "path") -> DataFrame:
    """Files of a kind that isn't published. ignored: names or paths that are kept out of what is published; some names and folders always are."""
    name = F.substring_index(path, "/", -1)
    fine = F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1).rlike(f"^(?:{ALLOWED_EXT})$")).otherwise(name.rlike(f"^(?:{ALLOWED_NAME})$"))
    kept_out = name.isin(*ignored, *ALWAYS_NAMED) | F.regexp_replace(path, r"^\./", "").isin(*ignored, "") | F.col(path).rlike(SKIPPED_FOLDERS)
    return files.where(~fine & ~kept_out).select(F.lit("stray").alias("gate"), F.col(path).alias("page"), name.alias("detail"))


def missing_markers(pages: DataFrame, markers: list[str], page: str = "path", html: str = "html") -> DataFrame:
    need = F.filter(F.array(*[F.lit(m) for m in markers]), lambda m: ~F.contains(F.col(html), m))
    return pages.select(F.lit("marker").alias("gate"), F.col(page).alias("page"), F.explode(need).alias("detail"))


def ignore_gaps(lines: DataFrame, line: str = "value", must: tuple[str, ...] = MUST_IGNORE) -> DataFrame:
    """What a list of ignored files has to name and doesn't; lines(value) are those of the list."""
    need = lines.sparkSession.range(1).select(F.explode(F.array(*[F.lit(m) for m in must])).alias("detail"))
    return need.join(lines.select(F.col(line).alias("detail")).distinct(), "detail", "left_anti").select(F.lit("ignored").alias("gate"), F.lit(".assetsignore").alias("page"), "detail")


def skip_links(pages: DataFrame, page: str = "path", html: str = "html") -> DataFrame:
    """Pages whose skip link or its target is missing, and those whose link doesn't lead to the target that they have."""
    h = F.col(html)
    tag = F.regexp_extract(h, r'(?i)<a\b[^>]*\bclass="(?:[^"]* )?skip-link(?: [^"]*)?"[^>]*>', 0)
    to = F.regexp_extract(tag, r'(?i)\bhref="#([^"]+)"', 1)
    held = F.contains(h, F.concat(F.lit('id="'), to, F.lit('"')))
    why = F.when(tag == "", "no skip link").when(~F.contains(h, F.lit('id="main"')), 'no id="main"').when((to == "") | ~held, "the skip link leads nowhere")
    return pages.select(F.lit("skip").alias("gate"), F.col(page).alias("page"), why.alias("detail")).where("detail is not null")


def not_current(committed: DataFrame, derived: DataFrame, gate: str, path: str = "path", content: str = "content") -> DataFrame:
    """Derived files that the committed copy lacks or has otherwise, and committed ones that nothing derives any more."""
    a, b = committed.select(path, F.col(content).alias("__c")), derived.select(path, F.col(content).alias("__d"))
    why = F.when(F.col("__c").isNull(), "not committed").when(F.col("__d").isNull(), "no longer derived").when(F.col("__c") != F.col("__d"), "differs")
    return a.join(b, path, "full_outer").select(F.lit(gate).alias("gate"), F.col(path).alias("page"), why.alias("detail")).where("detail is not null")


def stale_renders(pages: DataFrame, fresh: DataFrame, page: str = "path", html: str = "html") -> DataFrame:
    """Pages that differ from a fresh rendering of their source, or have none."""
    f = fresh.select(page, F.col(html).alias("__fresh"))
    return pages.join(f, page, "left").where(~F.col(html).eqNullSafe(F.col("__fresh"))).select(F.lit("render").alias("gate"), F.col(page).alias("page"), F.lit("differs from its source").alias("detail"))


def passed(found: DataFrame, gates: list[str]) -> DataFrame:
    """(gate, violations, passed) of every gate."""
    n = found.groupBy("gate").agg(F.count("*").alias("violations"))
    names = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(g) for g in gates])).alias("gate"))
    return names.join(n, "gate", "left").select("gate", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"), F.col("violations").isNull().alias("passed"))


def channel(hex_: Column, at: int) -> Column:
    c = F.conv(F.substring(hex_, at, 2), 16, 10).cast("double") / 255
    return F.when(c <= 0.03928, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def luminance(hex_: Column) -> Column:
    """Relative luminance of a colour written as six hex digits."""
    return channel(hex_, 1) * 0.2126 + channel(hex_, 3) * 0.7152 + channel(hex_, 5) * 0.0722


def contrast(a: Column, b: Column) -> Column:
    x, y = luminance(a), luminance(b)
    return (F.greatest(x, y) + 0.05) / (F.least(x, y) + 0.05)


def contrast_failures(tokens: DataFrame, grounds: DataFrame) -> DataFrame:
    """(token, ground, ratio, floor) of colour pairs below their floor (4.5 for text, 3.0 for edges). Both tables are a style sheet's few tokens."""
    pairs = tokens.crossJoin(F.broadcast(grounds))
    floor = F.when(F.col("role") == "edge", 3.0).otherwise(4.5)
    out = pairs.select("token", "ground", contrast(F.col("colour"), F.col("ground_colour")).alias("ratio"), floor.alias("floor"))
    return out.where("ratio < floor")


def css_tokens(css: Column) -> Column:
    """array<struct(name, hex)> of custom properties with a six-digit colour."""
    found = F.regexp_extract_all(css, F.lit(r"--[\w-]+\s*:\s*#[0-9a-fA-F]{6}"), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.regexp_extract(x, r"^--([\w-]+)", 1).alias("name"), F.regexp_extract(x, "#([0-9a-fA-F]{6})", 1).alias("hex")))

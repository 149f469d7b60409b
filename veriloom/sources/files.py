"""Recipes, manifests, ledgers and other JSON files as tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vocabularies and shapes of these files.
TRANSPORTS = ("curl", "web_fetch", "chrome")
EXTRACTORS = ("pdftotext-raw", "pdftotext-layout", "pdfplumber", "html-text", "next-data", "json-doc", "docx", "none")
PDF_EXTRACTORS = ("pdftotext-raw", "pdftotext-layout", "pdfplumber")
DOCX_SCOPES = ("paragraphs-and-tables", "paragraphs-only", "headers-paragraphs-and-tables", "headers-paragraphs-only")
USER_AGENTS, ENCODINGS, HTTP_VERSIONS = ("none", "browser"), ("cp1252",), ("1.1",)
RECIPE_VERSION, ANCHOR_LEAST = 1, 12
RESULTS = ("baseline", "confirmed", "drift", "rebuild", "accepted")
SOURCE = (
    "n int, title string, url string, urls array<string>, source_date string, transport string, extractor string, scope string, user_agent string, encoding string, http_version string, "
    "compressed boolean, ca_bundle string, pages array<int>, slice struct<`from`:string,`to`:string,from_occurrence:int,to_occurrence:int>, filters array<string>, "
    "drop_icon_space boolean, drop_sr_only boolean, attended boolean, notes string"
)
RECIPE = f"recipe_version int, state string, sources array<struct<{SOURCE}>>"
MANIFEST = (
    "date string, result string, kind string, hash string, sources int, urls array<string>, headers array<string>, capture string, stored boolean, transport string, supersedes string, date_source string, "
    "header_changes struct<gone:array<string>,new:array<string>>, shorter_sources array<struct<n:int,was:int,now:int>>, lost_content array<struct<n:int,was:int,now:int>>"
)
LEDGER = "page string, last_attempt string, last_result string, last_detail string, last_message string, attempts int, consecutive_hard_failures int, capture string, capture_submitted string"
# End of fixed values.


def recipes(spark: SparkSession, path: str) -> DataFrame:
    """Recipes with their file path; scope may be a string or an array and is read as JSON text."""
    return spark.read.schema(RECIPE).option("multiLine", True).json(path).withColumn("path", F.col("_metadata.file_path"))


def _option_rules(s: Column, i: Column, rule) -> list[Column]:
    """What options of a source s, at place i from 0, say that means nothing or doesn't fit its transport or extractor."""
    said = lambda name: F.coalesce(s[name], F.lit("")) != ""
    curl, text = s["transport"] == "curl", F.coalesce(s["scope"], F.lit(""))
    paths = F.from_json(text, "array<string>")
    curl_only = [(n, said(n)) for n in ("user_agent", "http_version", "encoding", "ca_bundle")] + [("compressed", ~s["compressed"]), ("urls", s["urls"].isNotNull())]
    out = [rule(on & ~F.coalesce(curl, F.lit(False)), f"{n} is for curl only") for n, on in curl_only]
    out += [rule(s[n].isNotNull() & (s["extractor"] != "html-text"), f"{n} is for html-text only") for n in ("drop_sr_only", "drop_icon_space")]
    known = {"user_agent": USER_AGENTS, "encoding": ENCODINGS, "http_version": HTTP_VERSIONS}
    out += [rule(said(n) & ~s[n].isin(*values), f"unknown {n}") for n, values in known.items()]
    slice_ = s["slice"]
    out += [
        rule(s["n"] != i + 1, "sources are not numbered in order"),
        rule(F.size(s["urls"]) < 2, "urls takes two pages or more"),
        rule(F.exists(s["urls"], lambda u: F.trim(u) == ""), "an empty url in urls"),
        rule(F.size(F.array_distinct(s["urls"])) < F.size(s["urls"]), "urls has a page twice"),
        rule(s["extractor"].isin("next-data", "json-doc") & (text == ""), "JSON without a path"),
        rule(s["extractor"].isin("next-data", "json-doc") & text.startswith("[") & (F.coalesce(F.size(paths), F.lit(0)) < 1), "JSON paths are no list of paths"),
        rule((s["extractor"] == "docx") & (text != "") & ~text.isin(*DOCX_SCOPES), "unknown scope of docx"),
        rule((text != "") & ~s["extractor"].isin("html-text", "next-data", "json-doc", "docx"), "a scope means nothing here"),
        rule(said("encoding") & s["extractor"].isin(*PDF_EXTRACTORS, "docx"), "encoding is for texts only"),
        rule(F.length(F.trim(slice_["from"])).between(1, ANCHOR_LEAST - 1), "the from anchor is too short"),
        rule(slice_["to"].isNotNull() & (F.trim(slice_["to"]) == ""), "the to anchor is empty"),
        rule(F.length(F.trim(slice_["to"])).between(1, ANCHOR_LEAST - 1), "the to anchor is too short"),
        rule(slice_["to_occurrence"].isNotNull() & slice_["to"].isNull(), "to_occurrence without to"),
    ]
    return out


def lint(recipes: DataFrame, options: bool = False) -> DataFrame:
    """(state, n, error): what is wrong with recipes, a row each; sound ones have none.

    options=True also looks at options: those that don't fit the source's transport or extractor, unknown values, anchors too short, the order
    of sources, the recipe's version and, where recipes have a path, whether the file bears the state's name.
    """
    src = recipes.select("state", "recipe_version", F.posexplode_outer("sources").alias("i", "s"))
    s = F.col("s")
    rule = lambda bad, said: F.when(F.coalesce(bad, F.lit(False)), F.lit(said))
    known = ("normalize-apostrophes", "normalize-ligatures", "strip-zero-width", "normalize-bullets", "strip-page-numbers", "unwrap-hard-wraps", "collapse-blank-runs", "trim-lines", "pipe-table-cells", "strip-running-headers", "join-wrap-hyphens")
    errors = F.array_compact(
        F.array(
            rule(F.col("i").isNull(), "no sources"),
            rule((F.col("i") == 0) & F.col("recipe_version").isNull(), "no recipe_version"),
            rule(s["n"].isNull() & s.isNotNull(), "source without n"),
            rule((F.coalesce(s["title"], F.lit("")) == "") & s.isNotNull(), "source without title"),
            rule(s["url"].isNull() & s["urls"].isNull() & s.isNotNull(), "neither url nor urls"),
            rule(s["url"].isNotNull() & s["urls"].isNotNull(), "both url and urls"),
            rule(~s["url"].rlike("^https?://"), "url is not http"),
            rule(F.exists(s["urls"], lambda u: ~u.rlike("^https?://")), "a url of urls is not http"),
            rule(~F.coalesce(s["transport"], F.lit("")).isin(*TRANSPORTS) & s.isNotNull(), "unknown transport"),
            rule(~F.coalesce(s["extractor"], F.lit("")).isin(*EXTRACTORS) & s.isNotNull(), "unknown extractor"),
            rule((s["extractor"] == "html-text") & s["scope"].isNull(), "html-text without scope"),
            rule(F.exists(s["filters"], lambda f: ~f.isin(*known)), "unknown filter"),
            rule(F.size(F.filter(F.coalesce(s["pages"], F.array()), lambda p: p >= 1)) != F.size(F.coalesce(s["pages"], F.array())), "pages begin at 1"),
            rule(s["pages"].isNotNull() & (F.size(s["pages"]) != 2), "pages is a pair"),
            rule(F.get(s["pages"], 0) > F.get(s["pages"], 1), "pages end before they begin"),
            rule(s["pages"].isNotNull() & ~s["extractor"].startswith("pdf"), "pages without a PDF"),
            rule(s["slice"].isNotNull() & (F.coalesce(s["slice"]["from"], F.lit("")) == ""), "slice without from"),
            rule((s["slice"]["from_occurrence"] < 1) | (s["slice"]["to_occurrence"] < 1), "occurrences begin at 1"),
            rule(s["urls"].isNotNull() & s["attended"], "urls can't be attended"),
            *(_option_rules(s, F.col("i"), rule) if options else []),
        )
    )
    if options:
        of_file = [F.when(F.coalesce(F.col("recipe_version") != RECIPE_VERSION, F.lit(False)), "unknown recipe_version")]
        if "path" in recipes.columns:
            of_file.append(F.when(~F.col("state").eqNullSafe(F.regexp_extract("path", r"([^/]+)\.json$", 1)), "the file is not named after the state"))
        whole = recipes.select("state", F.lit(None).cast("int").alias("n"), F.explode(F.array_compact(F.array(*of_file))).alias("error"))
    twice = recipes.select("state", F.explode("sources.n").alias("n")).groupBy("state", "n").count().where("count > 1").select("state", "n", F.lit("n occurs twice").alias("error"))
    found = src.select("state", s["n"].alias("n"), F.explode(errors).alias("error")).unionByName(twice)
    return found.unionByName(whole) if options else found


def manifest(spark: SparkSession, path: str, slug: str | None = None) -> DataFrame:
    """Rows of <slug>/manifest.jsonl files with slug and seq, the line's place, which decides what is latest.

    Files are read whole, as Spark gives lines no order. slug prunes files before they are opened.
    """
    raw = spark.read.text(f"{path}/{slug or '*'}/manifest.jsonl", wholetext=True)
    name = F.regexp_extract("_metadata.file_path", r"([^/]+)/manifest\.jsonl$", 1)
    rows = raw.select(name.alias("slug"), F.posexplode(F.split("value", "\n")).alias("seq", "line")).where(F.trim("line") != "")
    return rows.select("slug", "seq", F.from_json("line", MANIFEST).alias("r")).select("slug", "seq", "r.*")


def ledger(text: DataFrame, column: str = "value") -> DataFrame:
    """(url, fields...) from one JSON map of url to record; none if the text is null or no JSON."""
    m = F.from_json(column, f"sources map<string,struct<{LEDGER}>>")
    return text.select(F.explode(m["sources"]).alias("url", "r")).select("url", "r.*")


def island(text: Column, element: str) -> Column:
    """The content of a page's <script id=element>."""
    return F.regexp_extract(text, rf'(?s)<script[^>]*\bid="{element}"[^>]*>(.*?)</script>', 1)


def island_records(pages: DataFrame, element: str, schema: str, html: str = "html") -> DataFrame:
    """Records of a JSON array in a page's island; malformed JSON gives none."""
    return pages.select(F.explode(F.from_json(island(F.col(html), element), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def json_texts(doc: Column, paths: list[str]) -> Column:
    """The values at dotted or indexed paths joined by blank lines; a missing or null one fails the query."""
    values = []
    for p in paths:
        v = F.get_json_object(doc, "$." + p)
        values.append(F.when(v.isNull(), F.raise_error(F.lit(f"nothing at {p}"))).otherwise(v))
    return F.concat_ws("\n\n", *values)


def next_data(html: Column, paths: list[str]) -> Column:
    """Texts of a page's __NEXT_DATA__ island."""
    return json_texts(island(html, "__NEXT_DATA__"), paths)


#: What decode() of Spark knows; other encodings take an Arrow-batched function.
SPARK_CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32")


def _decode(encoding: str):
    @F.pandas_udf("string")
    def run(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda x: None if x is None else bytes(x).decode(encoding, "replace"))

    return run


def decode(content: Column, encoding: str = "UTF-8") -> Column:
    """struct(text, lossy): bytes as text; lossy if a replacement character came up."""
    if encoding.upper() == "UTF-8":
        text, lossy = F.make_valid_utf8(content.cast("string")), ~F.is_valid_utf8(content.cast("string"))
    else:
        text = F.decode(content, encoding) if encoding.lower() in SPARK_CHARSETS else _decode(encoding)(content)
        lossy = F.contains(text, F.lit("�"))
    return F.struct(text.alias("text"), lossy.alias("lossy"))


def refuse_lossy(decoded: Column, extracted: Column) -> Column:
    """The extracted text; fails if bytes were lost and a replacement character is left in it."""
    bad = decoded["lossy"] & F.contains(extracted, F.lit("�"))
    return F.when(bad, F.raise_error(F.lit("undecodable bytes in the extracted text"))).otherwise(extracted)


def verified_bytes(content: Column, sha256: Column, pdf: bool = False) -> Column:
    """Whether bytes are those declared: equal SHA-256, and for a PDF a header and a trailer."""
    ok = F.sha2(content, 256) == F.lower(sha256)
    if pdf:
        ok = ok & (F.substring(content, 1, 5) == F.lit(b"%PDF-")) & F.contains(F.hex(content), F.lit("2525454F46"))  # %%EOF
    return ok


def legacy_doc(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 8)) == "D0CF11E0A1B11AE1"


def draft(headers: DataFrame, header: str = "header", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., n, title, url, source_date, extractor) drafted from header lines; the address tells the extractor."""
    h = F.col(header)
    part = lambda i: F.trim(F.get(F.split(h, r"\|"), i))
    url = F.regexp_extract(h, r"https?://[^\s|]+", 0)
    kind = F.when(F.contains(F.lower(url), F.lit("pdf")), "pdftotext-layout").when(F.lower(url).endswith(".docx"), "docx").otherwise("html-text")
    return headers.select(
        *keep, F.regexp_extract(h, r"^SOURCE\s+(\d+)", 1).cast("int").alias("n"), F.regexp_replace(part(0), r"^SOURCE\s+\d+\s*[:|]?\s*", "").alias("title"), url.alias("url"),
        F.regexp_extract(h, r"(?i)source date:\s*([^|]*?)\s*(?:\||$)", 1).alias("source_date"), kind.alias("extractor"),
    )


def walk(spark: SparkSession, path: str, glob: str = "*", skip: str = r"/\.|__pycache__") -> DataFrame:
    """(path, length, content) of files below a path but the skipped, by path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).where(~F.col("path").rlike(skip)).select("path", "length", "content").orderBy("path")


def path_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """(path) of a list of paths: blank lines and comments are left out, trailing slashes too."""
    p = F.regexp_replace(F.trim(F.regexp_replace(column, r"(^|\s)#.*$", "")), "/+$", "")
    return lines.select(p.alias("path")).where("path <> ''")


def commit_dates(log: DataFrame) -> DataFrame:
    """(path, first_added, last_committed) from commits(hash, date, path)."""
    return log.groupBy("path").agg(F.min("date").alias("first_added"), F.max("date").alias("last_committed"))


def assembly_dates(captures: DataFrame, log: DataFrame) -> DataFrame:
    """captures(path, head, modified) with assembled and date_source: the date that the header tells, else of the file's first commit, else of its last change."""
    from veriloom.functions.dates import assembled

    told = assembled("head")
    c = captures.join(commit_dates(log).select("path", "first_added"), "path", "left")
    source = F.when(told.isNotNull(), "header").when(F.col("first_added").isNotNull(), "git").when(F.col("modified").isNotNull(), "mtime")
    date = F.coalesce(told, F.col("first_added").cast("string"), F.to_date("modified").cast("string"))
    return c.select(*captures.columns, date.alias("assembled"), source.alias("date_source"))


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(hash, date, path) of an exported log."""
    return spark.read.schema(T.StructType([T.StructField("hash", T.StringType()), T.StructField("date", T.DateType()), T.StructField("path", T.StringType())])).json(path)

"""Coverage of a dimension by surfaces, disagreement among them, freshness, and what a sitemap offers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Days a review lap may take, days after which a supplement is old, days the newest pass may be old.
LAP_DAYS, SUPPLEMENT_DAYS, NEWEST_DAYS = 25, 120, 2
# End of fixed values.


def gaps(surfaces: DataFrame, key: str, surface: str, names: list[str]) -> DataFrame:
    """(key, missing): surfaces that a key lacks though another has it; both directions in one grouped pass."""
    have = surfaces.groupBy(key).agg(F.collect_set(surface).alias("have"))
    return have.select(key, F.explode(F.array_except(F.array(*[F.lit(n) for n in names]), F.col("have"))).alias("missing"))


def disagreements(surfaces: DataFrame, key: str, surface: str, value: str) -> DataFrame:
    """(key, values): keys whose surfaces don't state one value; null is a value of its own."""
    said = surfaces.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(F.col(surface).alias("surface"), F.col(value).alias("value")))).alias("values"))
    return said.where(F.size(F.array_distinct(F.transform("values", lambda x: F.struct(x["value"])))) > 1)


def keep_all(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Every row of the dimension with its facts, nulls where there are none."""
    return dimension.join(facts, key, "left")


def required_but_missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return required.join(present.select(key).distinct(), key, "left_anti")


def soft_or_hard(failures: DataFrame, exempt: DataFrame, key: str) -> DataFrame:
    """failures with soft: whether their key is exempt."""
    e = exempt.select(key).distinct().withColumn("soft", F.lit(True))
    return failures.join(e, key, "left").withColumn("soft", F.coalesce("soft", F.lit(False)))


def run_totals(pages: DataFrame, failures: DataFrame, exempt: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """One row (pages, clean, soft, hard, passed) of a whole check: pages(key), failures(key), exempt(key). Soft failures only count under strict."""
    bad = soft_or_hard(failures.select(key).distinct(), exempt, key)
    n = pages.select(key).distinct().agg(F.count("*").alias("pages"))
    out = n.crossJoin(totals(bad))
    return out.select("pages", (F.col("pages") - F.col("soft") - F.col("hard")).alias("clean"), "soft", "hard", ((F.col("hard") == 0) & ((F.col("soft") == 0) | F.lit(not strict))).alias("passed"))


def totals(failures: DataFrame) -> DataFrame:
    return failures.agg(F.count_if(F.col("soft")).alias("soft"), F.count_if(~F.col("soft")).alias("hard"))


def ages(latest: DataFrame, today: Column, date: str = "date") -> DataFrame:
    """latest with age in days and stale: beyond a lap, or no date at all; undated first, then oldest."""
    age = F.datediff(today, F.to_date(date))
    return latest.withColumn("age", age).withColumn("stale", F.col("age").isNull() | (F.col("age") > LAP_DAYS)).orderBy(F.col("age").desc_nulls_first())


def sitemap(pages: DataFrame, excluded: list[str], drifted: DataFrame) -> DataFrame:
    """pages(path, html) with reason: why a page isn't offered (the first that holds), null if it is."""
    d = drifted.select("path").distinct().withColumn("__d", F.lit(True))
    named = F.col("path").isin(*excluded) if excluded else F.lit(False)
    why = F.when(named, "excluded by name").when(F.col("__d"), "recorded as drift, awaiting rebuild").when(noindex(F.col("html")), "declares noindex")
    return pages.join(d, "path", "left").select("path", why.alias("reason"))


def noindex(html: Column) -> Column:
    """Whether a robots or googlebot meta tag lists noindex, read leniently."""
    tags = F.regexp_extract_all(F.lower(html), F.lit(r"<meta[^>]*(?=>)"), F.lit(0))

    def says(tag: Column) -> Column:
        value = F.trim(F.get(F.split(tag, "content=", 2), 1))
        value = F.regexp_extract(F.regexp_replace(value, "^[\"']+|[\"']+$", ""), "^([^\"']*)", 1)
        listed = F.exists(F.split(value, ","), lambda x: F.trim(x) == "noindex")
        return F.contains(tag, F.lit("name=")) & (F.contains(tag, F.lit("robots")) | F.contains(tag, F.lit("googlebot"))) & F.coalesce(listed, F.lit(False))

    return F.exists(tags, says)


def canonical_path(path: Column) -> Column:
    """The address under which a page file is served, with a trailing slash."""
    return (
        F.when(path == "index.html", "/")
        .when(path.endswith("/index.html"), F.concat(F.lit("/"), F.regexp_replace(path, "index\\.html$", "")))
        .otherwise(F.concat(F.lit("/"), F.regexp_replace(path, "\\.html$", "/")))
    )


def other_paths(path: Column) -> Column:
    """Addresses that lead to the canonical one."""
    c = canonical_path(path)
    plain = (path != "index.html") & ~path.endswith("/index.html")
    forms = F.when(plain, F.array(F.concat(F.lit("/"), path), F.regexp_replace(c, "/+$", ""))).otherwise(F.array(F.concat(F.lit("/"), path)))
    return F.filter(forms, lambda f: f != c)


def page_order(path: Column) -> list[Column]:
    """Home first, then section indexes, then the rest by path."""
    return [path != "index.html", ~path.endswith("/index.html"), path]


def sitemap_xml(urls: DataFrame, base: str) -> DataFrame:
    """One row, one XML text, of urls(path, lastmod): a report of a site's pages, in order."""
    line = F.format_string("  <url><loc>%s%s</loc><lastmod>%s</lastmod></url>", F.lit(base), canonical_path(F.col("path")), F.col("lastmod"))
    ordered = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(page_order(F.col("path")))], line.alias("x"))))
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'
    return urls.agg(F.concat(F.lit(head), F.array_join(F.transform(ordered, lambda x: x["x"]), "\n"), F.lit("\n</urlset>\n")).alias("xml"))


def ratio(required: DataFrame, present: DataFrame, key: str, by: str) -> DataFrame:
    """(by, required, present, share): of what is required, by group, how much is there."""
    have = present.select(key).distinct().withColumn("__has", F.lit(True))
    g = required.join(have, key, "left").groupBy(by)
    return g.agg(F.count("*").alias("required"), F.count("__has").alias("present"), (F.count("__has") / F.count("*")).alias("share"))


def busiest(rows: DataFrame, kind: str, key: str, most: int) -> DataFrame:
    """(kind, key, n): the `most` keys of each kind with the most rows, ties to the smaller key."""
    n = rows.groupBy(kind, key).agg(F.count("*").alias("n"))
    return n.withColumn("__r", F.row_number().over(Window.partitionBy(kind).orderBy(F.desc("n"), key))).where(F.col("__r") <= most).drop("__r")


def priority(path: Column) -> Column:
    """How much a sitemap makes of a page: home, then section indexes, then the rest."""
    return F.when(path == "index.html", "1.0").when(path.endswith("/index.html"), "0.8").otherwise("0.6")


def robots(base: str, closed: list[str] | None = None) -> str:
    """A robots.txt that opens everything but the closed paths and names the sitemap."""
    return "User-agent: *\n" + ("".join(f"Disallow: {p}\n" for p in closed or []) or "Allow: /\n") + f"\nSitemap: {base}/sitemap.xml\n"


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)

"""Health of a nightly rotation: findings as rows (severity, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import dates as D
from veriloom.operators.coverage import LAP_DAYS, NEWEST_DAYS, SUPPLEMENT_DAYS
from veriloom.sources.packets import archival

# Faults of the archive account, not of a source.
ACCOUNT_FAULTS = ("submit-401", "playback-429")
# End of fixed values.


def packet_set(packets: DataFrame, lang: str = "en") -> DataFrame:
    """(slug, kind, path) of packet files <slug>-packet[-kind].txt: main first, then supplements by kind; another language is a set of its own."""
    base = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    slug, kind = F.regexp_extract(base, r"^(.+?)-packet(?:-.+)?$", 1), F.coalesce(F.nullif(F.regexp_extract(base, r"-packet-(.+)$", 1), F.lit("")), F.lit("main"))
    named = packets.select(slug.alias("slug"), kind.alias("kind"), "path").where("slug not in ('', 'TEMPLATE')")
    mine = F.col("kind") != "es" if lang == "en" else F.col("kind") == lang
    return named.where(mine).orderBy("slug", F.col("kind") != "main", "kind")


def review_errors(reviews: DataFrame, standing: str) -> DataFrame:
    """(slug, path, error): review captures(slug, path) that are standing packets or supplements, which can't replace a main packet."""
    base, folder = F.substring_index("path", "/", -1), F.regexp_replace("path", "/[^/]*$", "")
    error = F.when(folder == standing, "a standing packet").when(F.startswith(base, F.concat("slug", F.lit("-packet-"))), "a supplement")
    return reviews.select("slug", "path", error.alias("error")).where("error is not null")


def with_reviews(standing: DataFrame, reviews: DataFrame, folder: str) -> DataFrame:
    """A packet set (slug, kind, path) in which a slug's review capture(slug, path) stands for its main packet; a capture that can't fails the query."""
    wrong = review_errors(reviews, folder).select("path", "error").distinct()
    r = reviews.join(wrong, "path", "left").withColumn("path", F.when(F.col("error").isNull(), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("a review capture is "), "error"))))
    new = r.select("slug", F.lit("main").alias("kind"), "path")
    return standing.join(reviews.select("slug", F.lit("main").alias("kind")).distinct(), ["slug", "kind"], "left_anti").unionByName(new)


def report(
    latest: DataFrame, today: Column, slugs: DataFrame, cursor: str | None, cursor_before: bool, supplements: DataFrame, recipes: DataFrame, ledger: DataFrame, declared_faults: list[str]
) -> DataFrame:
    """(severity, message). latest(slug, date): newest pass of each slug; supplements(path, stem, head); recipes(stem); ledger(url, last_detail, last_result).

    severe: no passes, none lately, a lost or unknown cursor, faults of the account that rest sources. The rest is a note.
    """
    spark = latest.sparkSession
    say = lambda df, severity, message: df.select(F.lit(severity).alias("severity"), message.alias("message"))
    fixed = lambda severity, text: spark.range(1).select(F.lit(severity).alias("severity"), F.lit(text).alias("message"))
    age = F.datediff(today, D.tolerant_date("date"))
    all_ = latest.agg(F.count("*").alias("n"), F.min(age).alias("newest"), F.count_if(age > LAP_DAYS).alias("stale"), F.min("date").alias("oldest"))
    out = [
        say(all_.where("n = 0"), "severe", F.lit("no passes at all")),
        say(all_.where(F.col("newest") > NEWEST_DAYS), "severe", F.format_string("no pass recorded for %d days", "newest")),
        say(all_.where("stale > 0"), "note", F.format_string("%d not reviewed within a lap, oldest at %s", "stale", "oldest")),
    ]
    if cursor is None:
        out.append(fixed("severe", "the cursor is lost") if cursor_before else fixed("note", "the rotation has not started"))
    else:
        known = slugs.where(F.col("slug") == cursor)
        out.append(say(fixed("", "").join(known, how="left_anti"), "severe", F.lit(f"the cursor names {cursor!r}, which is not in the rotation")))
    live = supplements.where(~archival("head"))
    out.append(say(live.join(recipes.select("stem").distinct(), "stem", "left_anti"), "note", F.concat(F.lit("no recipe for "), "stem")))
    old = F.datediff(today, D.tolerant_date(D.assembled("head")))
    out.append(say(live.where(old > SUPPLEMENT_DAYS), "note", F.concat(F.lit("old supplement "), "stem")))
    missing = sorted(set(ACCOUNT_FAULTS) - set(declared_faults))
    if missing:
        out.append(fixed("severe", "undeclared account faults: " + ", ".join(missing)))
    resting = ledger.where(F.col("last_detail").isin(*ACCOUNT_FAULTS) & (F.col("last_result") == "FAILED")).agg(F.count("*").alias("n"))
    out.append(say(resting.where("n > 0"), "severe", F.format_string("%d sources rest on an account fault", "n")))
    return reduce(DataFrame.unionByName, out)


def healthy(findings: DataFrame) -> bool:
    return findings.where("severity = 'severe'").isEmpty()

"""Content-addressed history of captures, hash chains, and reports over both.

"Latest" is the last row in file order (seq), never the greatest date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def kind() -> Column:
    """The row's kind, main where it has none."""
    return F.coalesce(F.col("kind"), F.lit("main"))



def latest(rows: DataFrame, keys: list[str | Column], seq: str = "seq") -> DataFrame:
    """The last row in file order of each key: one aggregate with map-side combine, so that a hot key costs no more than others."""
    names = [k if isinstance(k, str) else f"__k{i}" for i, k in enumerate(keys)]
    cols = rows.columns
    keyed = rows.select(*[F.col(k).alias(f"__{n}") if isinstance(k, str) else k.alias(f"__{n}") for k, n in zip(keys, names, strict=True)], F.struct(*cols).alias("__row"))
    return keyed.groupBy(*[f"__{n}" for n in names]).agg(F.max_by("__row", F.col(f"__row.{seq}")).alias("__row")).select("__row.*")


def newest_stored(rows: DataFrame) -> DataFrame:
    """The newest row with a capture of each slug and kind."""
    return latest(rows.where("capture is not null").withColumn("kind", kind()), ["slug", "kind"])


def exempt(rows: DataFrame, results: tuple[str, ...] = ("drift", "accepted")) -> DataFrame:
    """(slug, result, kinds): kinds whose latest row has one of the results; a later row of the same kind clears it."""
    last = latest(rows.withColumn("kind", kind()), ["slug", "kind"]).where(F.col("result").isin(*results))
    return last.groupBy("slug", "result").agg(F.array_sort(F.collect_list("kind")).alias("kinds"))


def retain(captures: DataFrame, rows: DataFrame) -> DataFrame:
    """Manifest rows for new captures(slug, kind, date, result, hash, headers): stored if the hash moved or the result is drift, else an alias.

    One new capture a slug and kind at a time. Stored captures get a free name (day, day-b, day-c... and the characters after z)
    and name what they supersede; a day whose names are all taken fails the query.
    """
    # Dealt by slug first: both aggregates then sort a partition's rows, not all that a few files give a task.
    rows = rows.where("capture is not null").repartition("slug")
    prev = newest_stored(rows).select("slug", "kind", F.col("hash").alias("prev_hash"), F.col("capture").alias("prev_capture"), F.col("headers").alias("prev_headers"))
    new = captures.withColumn("kind", kind()).join(prev, ["slug", "kind"], "left")
    stored = ~(F.col("prev_hash").eqNullSafe(F.col("hash"))) | (F.col("result") == "drift")
    base = F.concat("date", F.when(F.col("kind") == "main", "").otherwise(F.concat(F.lit("-"), "kind")))
    taken = rows.groupBy("slug").agg(F.collect_set("capture").alias("taken"))
    new = new.join(taken, "slug", "left").withColumn("stored", stored)
    # Of as many names as are taken and one more, one is free.
    tails = F.transform(F.sequence(F.lit(0), F.coalesce(F.size("taken"), F.lit(0))), lambda i: F.when(i == 0, "").when(i < 159, F.concat(F.lit("-"), F.chr(i + 97))))
    names = F.transform(tails, lambda x: F.concat(base, x, F.lit(".txt")))
    free = F.coalesce(F.get(F.filter(names, lambda n: ~F.coalesce(F.array_contains("taken", n), F.lit(False))), 0), F.raise_error(F.lit("no free name")))
    both = lambda c: F.when(F.col("prev_headers").isNotNull() & (F.col("prev_headers") != F.col("headers")), c)
    return new.select(
        "slug", "kind", "date", "result", "hash", "headers",
        F.when(F.col("stored"), free).otherwise(F.col("prev_capture")).alias("capture"),
        "stored",
        F.when(F.col("stored"), F.col("prev_capture")).alias("supersedes"),
        both(F.filter("prev_headers", lambda x: ~F.array_contains("headers", x))).alias("headers_gone"),
        both(F.filter("headers", lambda x: ~F.array_contains("prev_headers", x))).alias("headers_new"),
    )


def captures(rows: DataFrame, key: str = "slug") -> DataFrame:
    """(key, captures, first_date, last_date): how many captures a key's history holds, and of which days."""
    return rows.groupBy(key).agg(F.count_distinct("capture").alias("captures"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def unknown_results(rows: DataFrame) -> DataFrame:
    """(slug, seq, result) of rows whose result none of the vocabulary is."""
    from veriloom.sources.files import RESULTS

    return rows.where(F.col("result").isNull() | ~F.col("result").isin(*RESULTS)).select("slug", "seq", "result")


def promote(rows: DataFrame) -> DataFrame:
    """The current capture of each slug and kind: that of its last confirmed, rebuilt or accepted row."""
    return latest(rows.withColumn("kind", kind()).where(F.col("result").isin("confirmed", "rebuild", "accepted")), ["slug", "kind"]).select("slug", "kind", "capture", "hash", "seq")


def backfill(standing: DataFrame, rows: DataFrame) -> DataFrame:
    """Standing packets whose slug has no history yet."""
    return standing.join(rows.select("slug").distinct(), "slug", "left_anti")


def shorter_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """(slug, n, was, now) of sources(slug, n, artifact, lines) whose artifact is the same and whose non-blank lines are fewer."""
    o = old.select("slug", "n", "artifact", F.col("lines").alias("was"))
    return new.select("slug", "n", "artifact", F.col("lines").alias("now")).join(o, ["slug", "n", "artifact"]).where("now < was").drop("artifact")


def verify_store(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(slug, capture, status): missing, hash mismatch or orphan, from manifest rows and files(slug, capture, hash)."""
    m = rows.where("capture is not null and stored").select("slug", "capture", F.col("hash").alias("told")).distinct()
    f = files.select("slug", "capture", F.col("hash").alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("told").isNull(), "orphan").when(F.col("told") != F.col("found"), "hash mismatch")
    return m.join(f, ["slug", "capture"], "full_outer").select("slug", "capture", status.alias("status")).where("status is not null")


def chain_breaks(entries: DataFrame, order: str = "id", digest: str = "entry_sha256", prev: str = "prev_entry_sha256", by: list[str] | None = None) -> DataFrame:
    """Entries whose link isn't the digest of the entry before; the first must have none. by: chains apart, so that no task takes all."""
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return entries.withColumn("expected", F.lag(digest).over(w)).where(~F.col(prev).eqNullSafe(F.col("expected")))


def manifest_status(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, status): changed or missing, of manifest(path, sha256) against files(path, sha256)."""
    f = files.select("path", F.col("sha256").alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("sha256"), "changed")
    return manifest.join(f, "path", "left").select("path", status.alias("status")).where("status is not null")


def manifest_lines(text: DataFrame) -> DataFrame:
    """(sha256, path) from lines "digest  path" of a text column value."""
    parts = F.split("value", "  ", 2)
    return text.where(F.trim("value") != "").select(F.get(parts, 0).alias("sha256"), F.get(parts, 1).alias("path"))


def code_digest(files: DataFrame, digits: int = 12) -> DataFrame:
    """One row: the first digits of SHA-256 over the contents of files(path, content), a few program files, in path order."""
    ordered = F.array_sort(F.collect_list(F.struct("path", F.hex("content").alias("h"))))
    return files.agg(F.substring(F.sha2(F.unhex(F.array_join(F.transform(ordered, lambda x: x["h"]), "")), 256), 1, digits).alias("digest"))


def attendance(rows: DataFrame, start: str, end: str) -> DataFrame:
    """(result, passes) of rows dated from start to end, both included, compared as text; a missing date is empty."""
    return rows.where(F.coalesce("date", F.lit("")).between(start, end)).groupBy(F.coalesce("result", F.lit("unknown")).alias("result")).agg(F.count("*").alias("passes"))


def drift_pairs(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Drift rows of a window with what they supersede: transport of both captures (last recorded wins) and the older one's date (first wins)."""
    facts = rows.where("capture is not null").groupBy("slug", "capture").agg(F.max_by(F.coalesce("transport", F.lit("")), "seq").alias("t"), F.min_by("date", "seq").alias("d"))
    drift = rows.where(F.coalesce("date", F.lit("")).between(start, end) & (F.col("result") == "drift"))
    now = facts.select("slug", "capture", F.col("t").alias("now"))
    was = facts.select("slug", F.col("capture").alias("supersedes"), F.col("t").alias("was"), F.col("d").alias("old_date"))
    return drift.select("slug", "date", "kind", "capture", "supersedes").join(now, ["slug", "capture"], "left").join(was, ["slug", "supersedes"], "left").orderBy("date", "slug")

"""Why two captures differ, source by source."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.functions.matching import ratio as matched_share
from veriloom.operators.nearby import points_in_ranges

# Verdicts in their order; the last two concern tools, not documents.
VERDICTS = ("document moved", "revision date changed", "text changed", "source dropped", "source added", "recipe filter changed", "extractor respacing")
PUBLISHABLE = VERDICTS[:5]
# End of fixed values.
MOVED, DATE, TEXT, DROPPED, ADDED, FILTER, RESPACED = VERDICTS


def _both(old: DataFrame, new: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    """One full outer join on the keys, which sides hold once: a_<name>, b_<name> of each column, and in_a, in_b."""
    a = old.select(*keys, *[F.col(c).alias(f"a_{k}") for k, c in columns.items()], F.lit(True).alias("in_a"))
    b = new.select(*keys, *[F.col(c).alias(f"b_{k}") for k, c in columns.items()], F.lit(True).alias("in_b"))
    return a.join(b, keys, "full_outer")


def _state() -> Column:
    """The state of a row of _both(body=...)."""
    na, nb = T.no_space("a_body"), T.no_space("b_body")
    return (
        F.when(F.col("in_b").isNull(), "gone")
        .when(F.col("in_a").isNull(), "new")
        .when(F.col("a_body").eqNullSafe(F.col("b_body")), "same")
        .when(na == nb, "respaced")
        .when(F.length(nb) >= F.length(na), "grew")
        .otherwise("shrank")
    )


def compare(old: DataFrame, new: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """(keys..., state, was, now): gone, new, same, respaced, grew or shrank, with lengths without whitespace.

    Equal lengths of different texts count as grew. One full outer join on the keys, which sides hold once.
    """
    size = lambda c: F.when(F.col("state").isin("grew", "shrank"), F.length(T.no_space(c)))
    return _both(old, new, keys, body=body).withColumn("state", _state()).select(*keys, "state", size("a_body").alias("was"), size("b_body").alias("now"))


def needs_review(compared: DataFrame, key: str) -> DataFrame:
    """Keys of which any source is gone or shrank."""
    return compared.groupBy(key).agg(F.bool_or(F.col("state").isin("gone", "shrank")).alias("needs_review"))


def header_fields(header: Column | str) -> Column:
    """struct(url, source_date, title) of a header line parted by pipes; absent parts are empty."""
    parts = F.transform(F.split(T._col(header), r"\|", -1), T.strip)
    first = lambda p: F.coalesce(F.get(F.filter(parts, p), 0), F.lit(""))
    date = first(lambda x: F.lower(x).startswith("source date:"))
    return F.struct(
        first(lambda x: x.startswith("http")).alias("url"),
        T.strip(F.substr(date, F.lit(13))).alias("source_date"),
        F.regexp_replace(F.get(parts, 0), r"^SOURCE\s*\d+\s*[|:]?\s*", "").alias("title"),
    )


def verdict(state: Column, old_header: Column, new_header: Column, old_body: Column, new_body: Column) -> Column:
    """The ladder: a real change of text overrides all; then a moved address, a changed date, a filter, respacing; null if nothing."""
    o, n = header_fields(old_header), header_fields(new_header)
    moved = (o["url"] != "") & (n["url"] != "") & (o["url"] != n["url"])
    dated = o["source_date"] != n["source_date"]
    changed = state.isin("grew", "shrank")
    same_lines = T.squash(T.strip_repeats(old_body)) == T.squash(T.strip_repeats(new_body))
    return (
        F.when(state == "gone", DROPPED)
        .when(state == "new", ADDED)
        .when(changed & ~same_lines, TEXT)
        .when(moved, MOVED)
        .when(dated, DATE)
        .when(changed, FILTER)
        .when(state == "respaced", RESPACED)
    )


def classify(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., state, verdict, url) from sources(keys..., header, body) of two captures; sources without a verdict are left out."""
    flat = lambda df: df.withColumns({c: T.flatten_retrieved(c) for c in ("header", "body")})
    full = _both(flat(old), flat(new), keys, header="header", body="body").withColumn("state", _state())
    c = F.col
    url = F.when(c("state") == "gone", header_fields(c("a_header"))["url"]).otherwise(header_fields(c("b_header"))["url"])
    return full.select(*keys, "state", verdict(c("state"), c("a_header"), c("b_header"), c("a_body"), c("b_body")).alias("verdict"), url.alias("url")).where("verdict is not null")


def rank(v: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in VERDICTS]), v)


def verdict_sets(classified: DataFrame, key: str) -> DataFrame:
    """(key, verdicts in their order, publishable)."""
    ordered = F.array_sort(F.collect_set(F.struct(rank(F.col("verdict")).alias("r"), F.col("verdict").alias("v"))))
    return classified.groupBy(key).agg(F.transform(ordered, lambda x: x["v"]).alias("verdicts"), F.bool_or(F.col("verdict").isin(*PUBLISHABLE)).alias("publishable"))


def lost_and_new(old: Column, new: Column) -> Column:
    """struct(gone, new) of two arrays; elements that repeat are kept as often as they occur."""
    return F.struct(F.filter(old, lambda x: ~F.array_contains(new, x)).alias("gone"), F.filter(new, lambda x: ~F.array_contains(old, x)).alias("new"))


def similarity(a: Column, b: Column) -> Column:
    """Share of matching characters of two squashed texts by the sequence matcher, to four places."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(matched_share(x, y), 4) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio(a, b)


def method_held(was: Column, now: Column) -> Column:
    """Equal notes, or equal lists of recipe digests that both notes name."""
    digests = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"recipe ([0-9a-f]{12})"), F.lit(1))
    return was.eqNullSafe(now) | ((F.size(digests(was)) > 0) & (F.size(digests(now)) > 0) & (digests(was) == digests(now)))


def code_stamp(raw: Column) -> Column:
    """The capture code's 12 digits in the notes before the first source; null if absent."""
    head = F.get(F.split(raw, r"(?m)^SOURCE\s*\d+", 2), 0)
    return F.nullif(F.regexp_extract(head, r"(?m)^- Capture code ([0-9a-f]{12}) ", 1), F.lit(""))


def code_change(pairs: DataFrame, commits: DataFrame | None) -> DataFrame:
    """pairs(id, old_raw, new_raw, since, until) -> (id, code_changed): null if the capture code held, else what is known.

    Without stamps, commits(hash, date) between the days, both included, decide: a range join by months, crowded ones in cells.
    """
    p = pairs.withColumns({"a": code_stamp(F.col("old_raw")), "b": code_stamp(F.col("new_raw"))})
    if commits is None:
        found = p.withColumn("hashes", F.lit(None).cast("array<string>"))
    else:
        c = commits.select(F.col("hash").alias("__h"), F.unix_date(F.to_date("date")).alias("__d"))
        spans = p.select("id", F.unix_date(F.to_date("since")).alias("__low"), F.unix_date(F.to_date("until")).alias("__high"))
        j = points_in_ranges(c, spans, "__d", "__low", "__high", "__h", "id", 31).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("__d", "__h"))).alias("c"))
        none = F.expr("cast(array() as array<string>)")
        found = p.join(j.select("id", F.transform("c", lambda x: x["__h"]).alias("hashes")), "id", "left").withColumn("hashes", F.coalesce("hashes", none))
    stamped = F.col("a").isNotNull() & F.col("b").isNotNull()
    said = (
        F.when(stamped & (F.col("a") == F.col("b")), None)
        .when(stamped, F.concat(F.lit("changed: "), "a", F.lit(" -> "), "b"))
        .when(F.col("hashes").isNull(), "unrecorded")
        .when(F.size("hashes") > 0, F.concat(F.lit("committed: "), F.array_join(F.slice("hashes", F.lit(1), F.lit(4)), ", "), F.when(F.size("hashes") > 4, F.concat(F.lit(" and "), (F.size("hashes") - 4).cast("string"), F.lit(" more"))).otherwise("")))
    )
    return found.select("id", said.alias("code_changed"))

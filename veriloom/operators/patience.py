"""What changed between two lists of paragraphs, as patience differences: joins and windows in rounds, no sequence matcher.

A round matches, in every stretch between matches so far, the paragraphs that occur once on either side (a join of grouped counts), and equal heads and tails.
Of these the longest chain that ascends on both sides is kept (a longest increasing subsequence a key), and the stretches between its links
are the next round's. Rounds end when none finds a match; texts that share most paragraphs take two or three.
Matches of a round are written to the shared folder.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.functions import text as T
from veriloom.session import scratch


def paragraphs(c: Column | str) -> Column:
    """Trimmed pieces between blank lines; empty ones are left out."""
    return F.filter(F.transform(F.split(F.col(c) if isinstance(c, str) else c, r"\n\s*\n", -1), T.strip), lambda p: p != "")


def chain(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j), sorted by i and then by j descending, make a longest chain that ascends strictly in both."""
    tops: list[int] = []
    at: list[int] = []
    back = np.full(len(j), -1)
    for k, v in enumerate(j.tolist()):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            at.append(k)
        else:
            tops[p], at[p] = v, k
        back[k] = at[p - 1] if p else -1
    out = np.zeros(len(j), bool)
    k = at[-1] if at else -1
    while k >= 0:
        out[k] = True
        k = back[k]
    return out


def _chains(pairs: DataFrame) -> DataFrame:
    """The longest chain of pairs(key, i, j) of each key; a key's pairs are as many as its paragraphs, three times at most.

    Where all pairs of a key ascend they are the chain, told by a window: most keys of texts that were hardly rearranged. A call of Python is for the others.
    """

    def run(table):
        t = table.sort_by([("i", "ascending"), ("j", "descending")])
        return t.filter(pa.array(chain(t["i"].to_numpy(), t["j"].to_numpy())))

    w = Window.partitionBy("key").orderBy("i", F.desc("j"))
    ascends = (F.col("i") > F.lag("i").over(w)) & (F.col("j") > F.lag("j").over(w))
    told = pairs.select("key", "i", "j").distinct().withColumn("up", F.coalesce(ascends, F.lit(True))).withColumn("up", F.bool_and("up").over(Window.partitionBy("key")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select("key", "i", "j").schema)
    crossed = told.where("not up").drop("up").groupBy("key").applyInArrow(run, schema)
    return told.where("up").drop("up").unionByName(crossed)


def _kept(df: DataFrame) -> DataFrame:
    path = scratch(df.sparkSession, "matches")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _left(side: DataFrame, matches: DataFrame, at: str) -> DataFrame:
    """side's rows that have no match yet, with seg: how many matches of their key come before.

    Both are dealt by key as one, which serves the groups and windows that follow too: a side goes over the network once a round.
    """
    both = side.withColumn("hit", F.lit(0)).unionByName(matches.select("key", F.col(at).alias("at"), F.lit(1).alias("hit")), allowMissingColumns=True)
    w = Window.partitionBy("key").orderBy("at")
    both = both.withColumns({"seg": F.sum("hit").over(w.rangeBetween(Window.unboundedPreceding, 0)), "here": F.sum("hit").over(w.rangeBetween(0, 0))})
    return both.where("here = 0").drop("hit", "here")


def _round(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (key, i, j) of one round in what is left of both sides."""
    once = lambda side, name: side.groupBy("key", "seg", "h").agg(F.count("*").alias("n"), F.min("at").alias(name)).where("n = 1").drop("n")
    found = once(a, "i").join(once(b, "j"), ["key", "seg", "h"]).select("key", "i", "j")
    for order in (F.asc("at"), F.desc("at")):  # heads, then tails
        w = Window.partitionBy("key", "seg").orderBy(order)
        edge = lambda side, name: side.select("key", "seg", "h", F.col("at").alias(name), F.row_number().over(w).alias("r"))  # noqa: B023, E731
        same = edge(a, "i").join(edge(b, "j"), ["key", "seg", "r", "h"])
        run = F.row_number().over(Window.partitionBy("key", "seg").orderBy("r"))
        found = found.unionByName(same.withColumn("n", run).where("n = r").select("key", "i", "j"))
    return found


def _sides(pairs: DataFrame, key: str, old: str, new: str, by: Column | None) -> tuple[DataFrame, DataFrame]:
    """(key, at, h) of the elements of either array, kept: h is a digest of what must be equal."""
    by = T.squash("p") if by is None else by
    side = lambda c: _kept(pairs.select(F.col(key).alias("key"), F.posexplode(c).alias("at", "p")).select("key", "at", F.substring(F.unhex(F.sha2(by, 256)), 1, 16).alias("h")))
    return side(old), side(new)


def _matches(a: DataFrame, b: DataFrame) -> DataFrame:
    kind = a.schema["key"].dataType.simpleString()
    done = a.sparkSession.createDataFrame([], f"key {kind}, i int, j int")
    while True:
        fresh = _kept(_chains(_round(_left(a, done, "i"), _left(b, done, "j"))))
        if fresh.isEmpty():
            return done
        done = fresh if done.isEmpty() else done.unionByName(fresh)


def matches(pairs: DataFrame, key: str, old: str, new: str, by: Column | None = None) -> DataFrame:
    """(key, i, j): places, from 0, of equal elements of the arrays old and new, ascending on both sides. Keys are distinct; null arrays are empty.

    by: what of an element must be equal, an expression of the column p (default: its letters and digits, lower-cased).
    """
    return _matches(*_sides(pairs, key, old, new, by))


def stretches(pairs: DataFrame, key: str, old: str, new: str, by: Column | None = None) -> DataFrame:
    """(key, seg) of the blocks, without their elements: texts are read for their digests alone, and never again."""
    a, b = _sides(pairs, key, old, new, by)
    m = _kept(_matches(a, b))
    return _left(a, m, "i").select("key", "seg").unionByName(_left(b, m, "j").select("key", "seg")).distinct().withColumnRenamed("key", key)


def blocks(pairs: DataFrame, key: str, old: str, new: str, by: Column | None = None) -> DataFrame:
    """(key, seg, tag, at, removed, added): what is between matches, in order of seg: from place `at` of old, `removed` elements give way to `added`.

    tag: replace, delete or insert. Elements are shown as they are, also where only `by` was compared.
    """
    m = _kept(matches(pairs, key, old, new, by))
    side = lambda c: pairs.select(F.col(key).alias("key"), F.posexplode(c).alias("at", "p"))
    listed = lambda df, name: df.groupBy("key", "seg").agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias(name))
    gone, come = listed(_left(side(old), m, "i"), "o"), listed(_left(side(new), m, "j"), "n")
    # Where an insertion stands in old: behind the match before it.
    w = Window.partitionBy("key").orderBy("i")
    behind = m.select("key", F.row_number().over(w).cast("long").alias("seg"), (F.col("i") + 1).alias("behind"))
    texts = lambda c: F.coalesce(F.transform(c, lambda x: x["p"]), F.expr("cast(array() as array<string>)"))
    both = gone.join(come, ["key", "seg"], "full_outer").join(behind, ["key", "seg"], "left")
    tag = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete").otherwise("replace")
    at = F.coalesce(F.col("o")[0]["at"], "behind", F.lit(0))
    return both.select(F.col("key").alias(key), "seg", tag.alias("tag"), at.alias("at"), texts("o").alias("removed"), texts("n").alias("added"))


def rebuilt(pairs: DataFrame, changes: DataFrame, key: str, old: str) -> DataFrame:
    """(key, new): old with its blocks carried out, which is what new was (elements that `by` takes for equal are old's)."""
    c = changes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "seg", F.size("removed").alias("n"), "added"))).alias("c"))
    j = pairs.select(key, F.coalesce(old, F.expr("cast(array() as array<string>)")).alias("o")).join(c, key, "left").withColumn("c", F.coalesce("c", F.filter(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("seg"), F.lit(0).alias("n"), F.expr("cast(array() as array<string>)").alias("added"))), lambda x: F.lit(False))))
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(F.col("c"), k - 1)["at"] + F.get(F.col("c"), k - 1)["n"])
    kept = lambda k, end: F.slice("o", start(k) + 1, F.greatest(end - start(k), F.lit(0)))
    pieces = F.flatten(F.transform("c", lambda x, k: F.concat(kept(k, x["at"]), x["added"])))
    return j.select(key, F.concat(pieces, kept(F.size("c"), F.size("o"))).alias("new"))

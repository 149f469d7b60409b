"""Joins by place: the next row after a place (as-of, forward, within a tolerance), and points in ranges. Equi-joins of cells, so that neither
falls back to comparing all pairs, and a hot key or a crowded stretch is several tasks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.operators.spread import block_join
from veriloom.session import scratch


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def asof_forward(left: DataFrame, right: DataFrame, key: str, at: str, pos: str, within: int, take: list[str]) -> DataFrame:
    """left with the columns `take` of the first right row of its key whose pos is in [at, at + within), null where there is none.

    at, pos: columns of whole numbers (of left, of right). Of right rows at one place the least by `take` counts. A key is cut into cells of `within`:
    a left row's answer is in its own cell or the next, so that right rows go to two cells, both sides are sorted in them as one, and the first right
    row that follows is carried back. A cell of one key is one task's; a key is not. Null keys and places meet nothing.
    """
    cell = lambda c: F.floor(F.col(c) / within)
    names = left.columns
    l_ = left.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(key).alias("key"), cell(at).alias("cell"), F.col(at).cast("long").alias("at"), F.lit(1).alias("side"))
    empty = F.lit(None)
    got = F.struct(F.col(pos).cast("long").alias("__pos"), *[F.col(c) for c in take])
    r_ = right.where(F.col(key).isNotNull() & F.col(pos).isNotNull()).select(
        F.col(key).alias("key"), F.explode(F.array(cell(pos), cell(pos) - 1)).alias("cell"), F.col(pos).cast("long").alias("at"), F.lit(0).alias("side"), got.alias("got")
    )
    both = l_.withColumn("got", empty.cast(r_.schema["got"].dataType)).unionByName(r_.withColumn("row", empty.cast(l_.schema["row"].dataType)))
    # Backwards by place: a right row at the left row's own place comes before it, and of equal places the least row last, which carries on.
    w = Window.partitionBy("key", "cell").orderBy(F.desc("at"), F.asc("side"), F.desc("got")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("next", F.last("got", ignorenulls=True).over(w)).where("side = 1")
    fits = F.col("key").isNotNull() & (F.col("next.__pos") < F.col("at") + within)
    return seen.select("row.*", *[F.when(fits, F.col(f"next.{c}")).alias(c) for c in take])


def points_in_ranges(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, point_by: str, range_by: str, width: int, most: tuple[int, int] | None = None) -> DataFrame:
    """points joined with ranges that hold them: low <= at <= high, whole numbers. No other column name is on both sides.

    The line is cut into bins of `width`; a range goes to each of its bins and a point to one, so that each pair meets once. A width near the ranges' own
    keeps copies few. Crowded bins are dealt to cells (block_join; most: its limits), for which sides are counted and dealt apart: both are written once,
    so that what they are made of is not computed anew each time. Wide columns are better joined afterwards.
    """
    p = _kept(points.where(F.col(at).isNotNull()), "points").withColumn("__bin", F.floor(F.col(at) / width))
    bins = F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width)))
    r = _kept(ranges.where(F.col(low) <= F.col(high)), "ranges").withColumn("__bin", bins)
    return block_join(p, r, "__bin", point_by, range_by, most).where(F.col(at).between(F.col(low), F.col(high))).drop("__bin")


def sums_in_ranges(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, **values: Column) -> DataFrame:
    """ranges with sums of values over the points they hold, nulls as 0: two lookups in running sums over places, no pair of point and range is made.

    Each value is summed by place first, which no crowd of points slows; then low and high look up the sums before and with them by one order
    of places and ends together.
    """
    from veriloom.operators.ordered import Ordered

    names = list(values)
    by_place = points.where(F.col(at).isNotNull()).groupBy(F.col(at).cast("long").alias("at")).agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(k) for k, v in values.items()])
    ends = ranges.select(F.col(low).cast("long").alias("low"), F.col(high).cast("long").alias("high")).where("low <= high").distinct()
    zero = [F.lit(0).cast("long").alias(k) for k in names]
    # At one place: sums before it (for low), the points, sums with it (for high).
    steps = (
        ends.select(F.col("low").alias("at"), F.lit(0).alias("turn"), *zero).distinct()
        .unionByName(by_place.select("at", F.lit(1).alias("turn"), *names))
        .unionByName(ends.select(F.col("high").alias("at"), F.lit(2).alias("turn"), *zero).distinct())
    )
    told = Ordered(steps, ["at", "turn"]).sums(**{f"s_{k}": F.col(k) for k in names}).select("at", "turn", *[f"s_{k}" for k in names])
    before = told.where("turn = 0").select(F.col("at").alias("low"), *[F.col(f"s_{k}").alias(f"b_{k}") for k in names])
    with_ = told.where("turn = 2").select(F.col("at").alias("high"), *[F.col(f"s_{k}").alias(f"w_{k}") for k in names])
    found = ends.join(before, "low").join(with_, "high").select(F.col("low").alias("__low"), F.col("high").alias("__high"), *[(F.col(f"w_{k}") - F.col(f"b_{k}")).alias(k) for k in names])
    same = (F.col(low).cast("long") == F.col("__low")) & (F.col(high).cast("long") == F.col("__high"))
    return ranges.join(found, same, "left").select(*ranges.columns, *[F.coalesce(k, F.lit(0)).alias(k) for k in names])

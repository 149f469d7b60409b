"""Equi-joins whose keys may be hot on either side: such keys' rows meet in blocks, so that no task takes a whole one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are set aside as hot on either side, at most, and the rows below which none is.
HOT_KEYS, HOT_LEAST = 4096, 2000


def limit(rows: int) -> int:
    """Rows of a key from which it counts as hot: not more than HOT_KEYS keys can have more."""
    return max(HOT_LEAST, -(-rows // HOT_KEYS))


def block_join(left: DataFrame, right: DataFrame, on: str, left_by: str, right_by: str, most: tuple[int, int] | None = None, counted: tuple[DataFrame | None, DataFrame | None] = (None, None)) -> DataFrame:
    """left joined with right on one column of theirs, inner; no other name is on both sides. left_by, right_by: columns that deal a key's rows to blocks.

    A key of L rows on the left and R on the right, of which either exceeds its limit, is dealt to ceil(L / limit) by ceil(R / limit) cells; each
    row goes to one line of cells, and each pair of rows meets in one. What is broadcast is the hot keys, 2 * HOT_KEYS at most; neither side is.
    Both sides are read twice, so they should be tables or cheap. most: limits, in place of those that follow from the numbers of rows.
    counted: in place of a side, narrow rows with its keys, about as often as there; a key's number of rows decides where its pairs meet, not which.
    """
    many = lambda df, name: df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias(name))
    keyed = [side if c is None else c for side, c in zip((left, right), counted, strict=True)]
    sizes = [many(side, "n") for side in keyed]
    if most is None:
        most = tuple(limit(s.agg(F.sum("n")).first()[0] or 0) for s in sizes)
    hot = [s.where(F.col("n") > m) for s, m in zip(sizes, most, strict=True)]
    keys = [r[0] for r in hot[0].select(on).unionByName(hot[1].select(on)).distinct().collect()]  # 2 * HOT_KEYS at most
    if not keys:
        return left.join(right, on)
    spark = left.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(k,) for k in keys], left.select(on).schema))
    cells = None
    for side, m, name in zip(keyed, most, ("__l", "__r"), strict=True):
        n = many(side.join(chosen, on, "left_semi"), name).withColumn(name, F.ceil(F.col(name) / m).cast("int"))
        cells = n if cells is None else cells.join(n, on)
    cells = F.broadcast(cells.coalesce(1))

    def dealt(df: DataFrame, by: str, own: str, other: str) -> DataFrame:
        d = df.join(cells, on, "left")
        mine = F.pmod(F.xxhash64(by), F.coalesce(F.col(own), F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return d.withColumn(f"{own}_at", mine).withColumn(f"{other}_at", every).drop("__l", "__r")

    # Merged, however small both are: a broadcast side would leave all pairs to as many tasks as the other has files.
    return dealt(left, left_by, "__l", "__r").join(dealt(right, right_by, "__r", "__l").hint("merge"), [on, "__l_at", "__r_at"]).drop("__l_at", "__r_at")

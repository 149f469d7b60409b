"""Places, running sums and the row before over one order of a whole table, without a task that takes all of it.

Rows are range-partitioned by the order and sorted in their partitions; a row's part and its place in it come with it, in a table that is
written once. What a part needs of the others is a row a part: how many rows, which sums and which last row come before it. The order should be
total: rows that tie in all its columns stay in one part, in any order among themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.session import scratch

#: What monotonically_increasing_id() holds below its partition's number.
_PLACE = (1 << 33) - 1


class Ordered:
    """A table in order. parts: range partitions (default: the session's shuffle partitions)."""

    def __init__(self, df: DataFrame, order: list[str | Column], parts: int | None = None):
        spark = df.sparkSession
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch(spark, "ordered")
        dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
        dealt.write.parquet(path)
        self.columns = df.columns
        table = spark.read.schema(dealt.schema).parquet(path)
        self.table = table.withColumns({"__part": F.shiftright("__id", 33).cast("int"), "__at": F.col("__id").bitwiseAND(_PLACE)}).drop("__id")

    def _parts(self, *aggs: Column) -> list:
        """A row a part, in order."""
        return self.table.groupBy("__part").agg(*aggs).orderBy("__part").collect()

    def _with(self, df: DataFrame, rows: list, schema: str) -> DataFrame:
        return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), "__part")  # a row a part

    def placed(self, name: str = "place") -> DataFrame:
        """The table with each row's place in the order, from 1."""
        rows, before = [], 0
        for r in self._parts(F.count("*").alias("n")):
            rows.append((r["__part"], before))
            before += r["n"]
        return self._with(self.table, rows, "__part int, __before long").withColumn(name, F.col("__before") + F.col("__at") + 1).select(*self.columns, name)

    def sums(self, exclusive: bool = False, **values: Column) -> DataFrame:
        """The table with running sums (longs) of values, the row's own included unless exclusive."""
        names = list(values)
        table = self.table.withColumns({f"__{k}": F.coalesce(v.cast("long"), F.lit(0)) for k, v in values.items()})
        totals = table.groupBy("__part").agg(*[F.sum(f"__{k}").alias(k) for k in names]).orderBy("__part").collect()
        rows, before = [], dict.fromkeys(names, 0)
        for r in totals:
            rows.append((r["__part"], *before.values()))
            before = {k: before[k] + r[k] for k in names}
        w = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
        inside = table.withColumns({k: F.coalesce(F.sum(f"__{k}").over(w), F.lit(0)) for k in names})
        schema = ", ".join(["__part int", *[f"__b_{k} long" for k in names]])
        return self._with(inside, rows, schema).withColumns({k: F.col(k) + F.col(f"__b_{k}") for k in names}).select(*self.columns, *names)

    def before(self, **values: str) -> DataFrame:
        """The table with columns of the row before (null in the first): new name = column."""
        last = self._parts(F.max_by(F.struct(*values.values()), "__at").alias("last"))
        table = self.table
        fields = {f.name: f.dataType.simpleString() for f in table.schema}
        rows, held = [], (None,) * len(values)
        for r in last:
            rows.append((r["__part"], *held))
            held = tuple(r["last"])
        w = Window.partitionBy("__part").orderBy("__at")
        schema = ", ".join(["__part int", *[f"`__b_{k}` {fields[c]}" for k, c in values.items()]])
        inside = table.withColumns({f"__l_{k}": F.lag(c).over(w) for k, c in values.items()})
        out = {k: F.when(F.col("__at") == 0, F.col(f"__b_{k}")).otherwise(F.col(f"__l_{k}")) for k in values}
        return self._with(inside, rows, schema).withColumns(out).select(*self.columns, *values)


def placed(df: DataFrame, order: list[str | Column], name: str = "place") -> DataFrame:
    """df with each row's place in an order, from 1."""
    return Ordered(df, order).placed(name)


def chain_breaks(entries: DataFrame, order: list[str], digest: str, prev: str) -> DataFrame:
    """Entries of one chain over the whole table whose link isn't the digest of the entry before, with the digest expected; the first must have none."""
    return Ordered(entries, order).before(expected=digest).where(~F.col(prev).eqNullSafe(F.col("expected")))


def within_budget(attempts: DataFrame, order: list[str], success: Column, fault: Column, successes: int, most: int) -> DataFrame:
    """Attempts of one run over the whole table: until so many succeeded, `most` were made, or an account fault came up, which is the last."""
    run = Ordered(attempts, order).sums(exclusive=True, __won=success.cast("int"), __lost=fault.cast("int"), __made=F.lit(1))
    return run.where((F.col("__won") < successes) & (F.col("__lost") == 0) & (F.col("__made") < most)).select(*attempts.columns)

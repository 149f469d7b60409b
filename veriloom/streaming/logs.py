"""Append-only logs as streams: monthly attendance, a current table by batches, round robins. Histories with state of their own are in stateful.

File order, not event time, decides what is latest, so there is no watermark; events carry seq.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def monthly(events: DataFrame, time: str = "ts", result: str = "result") -> DataFrame:
    """(month, result, passes): calendar months, which window() can't express; works on streams (complete or update mode) and on tables."""
    return events.groupBy(F.date_trunc("month", time).alias("month"), F.coalesce(result, F.lit("unknown")).alias("result")).agg(F.count("*").alias("passes"))


def current_by_key(spark: SparkSession, stream: DataFrame, path: str, keys: list[str], seq: str = "seq"):
    """A streaming query that keeps the newest row of each key in a table of versions below path; each batch writes the next one.

    A batch that runs again writes the same version, so that its rows are counted once; versions older than the one it reads are deleted.
    """
    from veriloom.operators.history import latest

    def merge(batch: DataFrame, epoch: int) -> None:
        new = batch
        if epoch:
            new = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/v={epoch - 1}"))
        latest(new, keys, seq).write.mode("overwrite").parquet(f"{path}/v={epoch}")
        if epoch > 1:  # the version before stays, as this batch may run again
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={epoch - 2}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/_log").trigger(availableNow=True).start()


def night(items: DataFrame, key: str, per_night: int, cursor: int) -> DataFrame:
    """The items of a round robin's next night: places cursor to cursor + per_night - 1 in order of key, around the end. items is a bounded dimension."""
    from pyspark.sql.window import Window

    n = items.count()
    place = F.row_number().over(Window.orderBy(key)) - 1
    return items.withColumn("place", place).where(F.pmod(F.col("place") - cursor, F.lit(max(n, 1))) < per_night)


def until_fault(attempts: DataFrame, order: str, fault: str) -> DataFrame:
    """A batch's attempts before and with the first account fault; the rest are untouched."""
    first = attempts.agg(F.min(F.when(F.col(fault), F.col(order))).alias("__stop"))
    return attempts.crossJoin(F.broadcast(first)).where(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).drop("__stop")

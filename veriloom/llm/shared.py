"""What several operators need: cut lineage, bounded Bloom filters, joins that spread hot keys, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.session import scratch, ship


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and a lost executor costs nothing before.

    Tables that a returned DataFrame still reads stay in the folder, which is the cluster's to clean; forget() deletes the others.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._veriloom_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by cut() that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._veriloom_path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Bits of a filter, least and most: 2 ** 25 is 524,288 rows of a broadcast table.
BLOOM_LEAST, BLOOM_MOST = 16, 25
#: Keys that a join sets aside as hot, at most, and the rows below which none is.
HOT_KEYS, HOT_LEAST = 4096, 1000


def prepare(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """This package on the workers, and Arrow batches small enough that a few of long texts fit a worker beside its executor."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def bloom(ids: DataFrame, column: str, most: int = BLOOM_MOST) -> DataFrame:
    """A one-hash filter over a long column of a table: (__w, __m), 64-bit words of a bitmap, written to the shared folder.

    The bitmap has sixteen bits an id, 2**most at most, that is, at most 2**most / 64 rows of 16 bytes (524,288 by default)
    whatever the input's size, which is what makes it fit to broadcast. Beyond 2**most / 16 ids it fills up: more rows than need be
    pass it, in the end all of them, and are shuffled; none is lost or taken in wrongly, as every user confirms by an exact join.
    """
    bits = min(most, max(BLOOM_LEAST, (16 * ids.count()).bit_length()))
    slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << bits))
    words = (
        ids.where(F.col(column).isNotNull())
        .select(slot.alias("s"))
        .groupBy(F.expr("cast(s div 64 as int)").alias("__w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("__m"))
    )
    out = cut(words, "bloom")
    out._veriloom_bits = bits
    return out


def flagged(df: DataFrame, value: Column, words: DataFrame, flag: str) -> DataFrame:
    """df with a boolean column that is false only for longs that were not in the filter's input, and for nulls."""
    s = F.pmod(F.xxhash64(value.cast("long")), F.lit(1 << words._veriloom_bits))
    w = words.select(F.col("__w").alias(f"__w_{flag}"), F.col("__m").alias(f"__m_{flag}"))
    out = df.withColumn(f"__s_{flag}", s).join(F.broadcast(w), F.expr(f"cast(__s_{flag} div 64 as int) = __w_{flag}"), "left")
    hit = F.expr(f"coalesce((shiftright(__m_{flag}, cast(__s_{flag} % 64 as int)) & 1) = 1, false)") & value.isNotNull()
    return out.withColumn(flag, hit).drop(f"__s_{flag}", f"__w_{flag}", f"__m_{flag}")


def join_spread(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, how: str = "inner", most: int | None = None) -> DataFrame:
    """rows joined with keyed, one row a key, whose column `weight` says how many of rows have the key; inner or left.

    No key meets in one task: those of more rows than HOT_LEAST and than a HOT_KEYS-th of all are joined by broadcast, which is at most
    HOT_KEYS rows since the weights add up to all rows; the rest is shuffled, and none of it is hot.
    rows and keyed are read more than once, so they should be tables. most: what no key's weight is known to exceed.
    """
    if most is not None and most <= HOT_LEAST:
        return rows.join(keyed, on, how)
    total, most = keyed.agg(F.sum(weight), F.max(weight)).first()
    limit = max(HOT_LEAST, (total or 0) // HOT_KEYS)
    if (most or 0) <= limit:
        return rows.join(keyed, on, how)
    hot = F.broadcast(keyed.where(F.col(weight) > limit))
    rest = rows.join(hot, on, "left_anti").join(keyed.where(F.col(weight) <= limit), on, how)
    return rows.join(hot, on).unionByName(rest)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges(u, v): (node, component), component the smallest reachable node.

    Alternating large-star and small-star rounds: each is a grouped minimum with map-side combine and
    a join that spreads hot keys, so that a node with very many neighbours needs no single task. A round's
    edges are written to the shared folder; rounds stop when the edge set no longer changes.
    Nodes without an edge to another node aren't returned.
    """
    e = cut(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name
    )
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("c"))
        most = low.agg(F.max("c")).first()[0] or 0
        large = join_spread(both, low, ["u"], "c", most=most).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
        small = (
            join_spread(large, low, ["u"], "c", most=most)  # a node has no more edges than before
            .select(F.expr("stack(2, u, m, v, m) as (u, v)"))
            .where("u <> v")
            .distinct()
        )
        nxt = cut(small, name)
        now = nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        forget(e)
        e = nxt
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _packed(docs: DataFrame, id_col: str) -> DataFrame:
    """(row, id): docs' columns as one struct, so that no name of theirs clashes with one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"))


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", name: str = "dropped") -> DataFrame:
    """docs but the rows whose id is among ids(id): an anti-join that shuffles only rows that a bounded filter can't clear.

    Rows with a null id stay.
    """
    gone = cut(ids.select(F.col("id").cast("long").alias("gone")).where("gone is not null").distinct(), name)
    marked = flagged(_packed(docs, id_col), F.col("id"), bloom(gone, "gone"), "hit")
    rest = marked.where("hit").join(gone, F.col("id") == F.col("gone"), "left_anti")
    return marked.where("not hit").select("row.*").unionByName(rest.select("row.*"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of those that repeat an id and its text. Only rows of repeated ids are shuffled; null ids stay."""
    packed = _packed(docs, id_col)
    often = cut(packed.where("id is not null").groupBy("id").count().where("count > 1").select("id"), "often")
    if often.isEmpty():
        return docs
    marked = flagged(packed, F.col("id"), bloom(often, "id"), "hit")
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    rest = marked.where("hit").withColumn("h", F.sha2(text.cast("binary"), 256)).dropDuplicates(["id", "h"])
    return marked.where("not hit").select("row.*").unionByName(rest.select("row.*"))

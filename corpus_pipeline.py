"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's docs.

Every stage works on all that its predecessor kept and returns the columns of documents, but for the
last, which returns token ids. Rows with null ids or texts pass through the filters. Texts are taken whole, of any
length; further columns pass through the filters, also those that have names of an operator's own; empty tables give empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.llm import bpe, decontam, minhash, secretscan, toxicity
from veriloom.llm.shared import cut, one_of_each, prepare, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine trained on the labelled ones among them scores below 0.5. Null and empty texts score the machine's prior;
    repeated rows are scored alike; without labels nothing is rejected."""
    prepare(spark)
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word shingles of similarity 0.8 or more."""
    prepare(spark)
    found = minhash.groups(docs, minhash.Plan(words=5, percent=80))
    gone = found.where("not kept").select(F.col("doc_id").alias("id"))
    return one_of_each(without(docs, gone, name="near-copies"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in any order of its parts. Null and empty texts, and rows without an id, hold none; rows that
    repeat an id go if the text of one of them holds an item."""
    prepare(spark)
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.select(F.col("doc_id").alias("id")), name="contaminated")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted again."""
    prepare(spark)
    return secretscan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of what they decode to, and the ids. A null text is empty; repeated rows are repeated."""
    prepare(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("encoding", encode),
]

#: SQL can't express the stages: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxic documents go, copies go, leaked benchmarks go, the rest is tokenized."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import decontaminate, exact_dedup, sentencepiece_codec, simhash, toxicity
from wardlight.llm.common import table
from wardlight.session import settle, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(docs, sentencepiece_codec.load(), ["doc_id", "lang", "source"])
    return coded.withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact),
    ("simhash_dedup", drop_near),
    ("decontamination", drop_leaks),
    ("sentencepiece", tokenize),
]

# The stages hold a fitted model, fingerprints, an edit search and a tokenizer: no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again so that a lost executor costs one stage."""
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.mode("overwrite").parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs

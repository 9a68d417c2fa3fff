"""The corpus pipeline: documents in, training tokens out, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``; every stage works on all that its predecessor kept.

A stage keeps any further columns that ``docs`` brings; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import bpe, mixing, pii, quality_rules, simhash
from surveyloom.llm.common import shared_folder

#: The pipeline has no SQL: fingerprints and tokens are beyond it. Tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints linked at two bits or fewer) the
    document with the smallest id stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind in brackets."""
    masked = pii.mask(F.col("text"), pii.train(docs))
    cleaned = docs.withColumn("text", masked)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's share takes them."""
    return mixing.curriculum(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids and the digest of the text they decode to."""
    model = spark.sparkContext.broadcast(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    encoded = docs.select("doc_id", "source", bpe.encode(F.col("text"), model).alias("ids"))
    decoded = encoded.withColumn("_text", bpe.decode(F.col("ids"), model))
    return decoded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                          F.sha2("_text", 256).alias("text_sha256"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{spark.sparkContext.applicationId}-{id(docs)}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.mode("overwrite").parquet(f"{folder}/{k}_{name}")
            docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs

"""Corpus pipeline: five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept; its decisions take effect.  All but the last return the
columns of documents.  ``run`` writes each stage's result as Parquet into the
shared folder and reads it again for the next.

Nulls, empty and long texts, repeated rows, empty tables and further columns
are treated as the operators' docstrings say; further columns are dropped.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import byte_bpe, decontaminate, simhash, suffix_dedup, toxicity
from quarry.session import ensure_checkpoint_dir, load, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a repeated string that is cut: a passage of just over 50 words has mostly 200 to 400.
REPEAT_BYTES = 200


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity does not reject them."""
    ship_package(spark)
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=COLUMNS[1:]).where(~toxicity.rejected()).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id."""
    ship_package(spark)
    return simhash.keep_one(docs.select(COLUMNS), shingle=4, max_bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of ``REPEAT_BYTES`` that also start elsewhere; n_chars follows."""
    ship_package(spark)
    cut = suffix_dedup.remove_repeats(docs, min_len=REPEAT_BYTES, keep=["lang", "source"], as_text=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows do not contaminate."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs.select(COLUMNS), load(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(ids, path, public_tokenizers.PATTERN))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_array_dedup", cut_repeats),
          ("decontamination", drop_contaminated), ("byte_bpe", tokenize)]

#: SQL can express neither the model nor XXH64 nor the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents table."""
    docs = load(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxicity, n-gram Jaccard join, benchmark decontamination,
byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept; all but the last return the columns of ``documents``.  A
runner writes each stage's result as Parquet and reads it again for the next.
Since rows are whole texts, each stage limits the session's Arrow batches to
1,024 rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe_codec, qgram_decontam, signature_join, toxicity_chain
from ledgerlens.llm.common import read_table, stage, text_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; it is fitted on the labelled ones among ``docs``."""
    text_batches(spark)
    return toxicity_chain.drop_toxic(docs, toxicity_chain.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked, directly or over others, the one with the smallest id stays."""
    text_batches(spark)
    return signature_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also a slightly edited one, go."""
    text_batches(spark)
    return qgram_decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    text_batches(spark)
    return bpe_codec.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                      ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_contaminated), ("byte_bpe", encode)]

#: A trained classifier and an edit distance search are no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs

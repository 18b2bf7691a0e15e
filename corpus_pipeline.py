"""The corpus pipeline: stages (name, function) applied in turn, each on the table that its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from strata.llm.common import shared_path, table


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the model, learnt from the labels of these documents, predicts toxic go."""
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: one line of each group of near-equal lines stays, in the first document that has one."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one_of_each(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: (doc_id, n_tokens, ids_sha256, decoded_sha256) of each text, its ids and what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", harmless), ("line_dedup", unique_lines), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontamination), ("byte_bpe", encoded)]

#: Stages that learn, cluster or run a tokenizer have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = shared_path(spark, name)
            out.write.parquet(path)
            out = spark.read.parquet(path)
        docs = out
    return docs

"""The corpus pipeline: quality rules, line dedup, near copies, source mix and packing, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm import lines, minhash, mixing, packing, quality
from tallyroll.llm.common import scratch, written

# Verified sets, hash functions and token files are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. NULL, blank and short texts fail the base rules and go; a very long text is
    counted whole; equal rows are judged alike; an empty table stays empty; columns stay as they are."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line already says. NULL texts stay NULL and blank lines stay; very long texts
    are read line by line; ties go to the least doc_id, text hash and place; equal rows keep the same lines; an empty table stays empty."""
    return lines.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least doc_id, then the least text hash. Texts without words are in no
    group and stay; very long texts are compared whole; of equal rows one stays; an empty table stays empty."""
    return minhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, at most twice each. NULL texts and sources are an empty text and a source of its own; a
    very long text counts whole; ties go by key and doc_id; equal rows are one document; an empty table stays empty."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces; a document that the mix took twice is packed twice."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", drop_bad),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch() as keep:  # what a stage wrote on its way goes once its result is written
            docs = keep(written(stage(spark, docs, sf_dir)))
    return STAGES[-1][1](spark, docs, sf_dir)

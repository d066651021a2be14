"""From the table of documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept; every result is written as Parquet and read
back. The first four return the columns of documents:

1. quality rules: documents that the rules reject go;
2. line dedup: later copies of repeated runs of lines are cut out of the texts;
3. near-dedup: one document of each group of near-duplicates (five-word shingles, 0.8) stays;
4. decontamination: documents that hold a benchmark item go;
5. packing: the tokens of what is left, as pieces of sequences.

A document whose lines were all copies is left with an empty text; it goes on, since stages 3 and
4 find nothing wrong with it, and is packed as its end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from millrace.llm.common import table
from millrace.session import store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs).select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, near_dedup.USUAL)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", cut_lines),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Token ids, fingerprints and signatures have no words in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs

"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A document is known by its number and the hash of its text: rows that agree in both are one
# document stored several times and get the same result.
KEY = ("_id", "_hash")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text (null: empty); all other columns go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the two columns of ``KEY``; a null doc_id is smaller than any other."""
    return docs.withColumns(
        {
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
            "_hash": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def doc_id() -> Column:
    return F.when(F.col("_id") != -(2**63), F.col("_id")).alias("doc_id")


def fold(column: str, divisor: int) -> Column:
    """crc32 of the number as text, modulo ``divisor``; a null number counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def map_rows(df: DataFrame, schema: str, fn: Callable[[list[list]], list[Iterable]], rows: int = 512) -> DataFrame:
    """Apply ``fn`` to the columns of at most ``rows`` rows at a time: lists in, lists out.

    Pieces are bounded so that a batch of long texts is never a Python list as a whole."""
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                piece = batch.slice(start, rows)
                columns = fn([c.to_pylist() for c in piece.columns])
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow)],
                    schema=arrow,
                )

    return df.mapInArrow(run, out)

"""Event journal in Parquet: rows ``(persistence_id, partition_nr, sequence_nr, ...)`` with
``partition_nr = sequence_nr div size``.

Folders hold ``FOLDER_PARTITIONS`` partitions each, so that small partitions make neither many
folders nor many small files; within, rows are clustered by id and number, which row groups tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.ordered import Ordered
from millrace.session import store

FOLDER_PARTITIONS = 1000


def with_partition(df: DataFrame, size: int) -> DataFrame:
    return df.withColumn("partition_nr", F.expr(f"sequence_nr div {size}"))


def write_journal(df: DataFrame, path: str, size: int) -> None:
    """Append to the journal. Clustered by folder, id and number, so that each task writes few
    files and a read touches few row groups."""
    rows = with_partition(df, size).withColumn("folder", F.expr(f"partition_nr div {FOLDER_PARTITIONS}"))
    clustered = rows.repartitionByRange("folder", "persistence_id", "sequence_nr")
    clustered.sortWithinPartitions("folder", "persistence_id", "sequence_nr").write.mode("append").partitionBy("folder").parquet(path)


def read_journal(
    spark: SparkSession, path: str, offset: int, size: int, persistence_id: str | None = None, ordered: bool = True
) -> DataFrame:
    """Rows from ``offset`` on, up to the first partition in which the id has none, by id and
    sequence number (unless ``ordered`` is false).

    The folder bound prunes folders, the number and the id are pushed to the scan. Without an id,
    all journals are read, each with its own end. Where a journal ends follows from its list of
    partitions, which is made by one scan of two columns and stored, one row per partition.
    """
    first = offset // size
    rows = spark.read.parquet(path).where((F.col("folder") >= first // FOLDER_PARTITIONS) & (F.col("sequence_nr") >= offset)).drop("folder")
    if persistence_id is not None:
        rows = rows.where(F.col("persistence_id") == persistence_id)
    partitions = store(rows.select("persistence_id", "partition_nr").distinct(), "partitions")
    numbered = Ordered.of(partitions, "persistence_id", "partition_nr").position("_n").df
    reached = numbered.where(F.col("partition_nr") - F.col("_n") == first - 1).drop("_n")
    read = rows.join(reached, ["persistence_id", "partition_nr"], "left_semi")
    return read.orderBy("persistence_id", "sequence_nr") if ordered else read

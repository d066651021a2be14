"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest number of rows that one window partition or one stateful scan may hold
# before an operator splits the group (see millrace.ordered).
ROWS_PER_TASK_CONF = "spark.millrace.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 5_000_000

# Rows of one part of a shuffle whose size is known beforehand.
ROWS_PER_PART = 500_000

# A side of a join may be broadcast when it was counted and has at most this many rows, and its
# rows as text at most this many bytes.
BROADCAST_ROWS_CONF = "spark.millrace.broadcastRows"
DEFAULT_BROADCAST_ROWS = 200_000
BROADCAST_BYTES_CONF = "spark.millrace.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 64 << 20


def local_session(cores: int | str = 8, app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and local benches; on a cluster use spark-submit's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK)))


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    # "local-cluster[...]" has executors of its own.
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    sc.setCheckpointDir(folder)
    return folder


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """The path as Hadoop has it, and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed by Hadoop when the driver exits."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    found, fs = hadoop_path(spark, path)
    fs.deleteOnExit(found)
    return path


def spread(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """``df`` of about ``rows`` rows, shuffled by ``columns`` into parts of about
    ``ROWS_PER_PART`` where Spark's own number of shuffle partitions would make larger ones."""
    parts = -(-(rows or 0) // ROWS_PER_PART)
    return df if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(parts, *columns)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

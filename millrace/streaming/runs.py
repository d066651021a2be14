"""Running streams to the end of what is available, with files as source and sink.

Every run uses ``availableNow``: it takes what is there, in bounded micro-batches if the
source sets ``maxFilesPerTrigger``, and stops. A run that was lost is started again with
the same checkpoint and continues where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.timewindows import batches
from millrace.ordered import Ordered
from millrace.session import ROWS_PER_PART, hadoop_path, scratch_path, store
from millrace.sources.writers import show, write_batch

# Keys share the state of a bucket (see ``millrace.streaming.timed``); a stream keeps their number.
BUCKETS_CONF, BUCKETS_PER_PART = "spark.millrace.streamBuckets", 32
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with checkpoints in shared storage, instead of in memory;
    needed by the stateful processors."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A growing folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append results to a Parquet folder; its log makes the output exactly-once."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to ``each(batch, batch_id)``. A batch may come twice after a
    failure, so ``each`` writes by batch number (see ``write_batch``)."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_console(stream: DataFrame, n: int = 20) -> StreamingQuery:
    """Print some rows of every micro-batch."""
    query = (
        stream.writeStream.outputMode("append").format("console").option("numRows", n).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def console_and(folder: str, n: int = 20) -> Callable[[DataFrame, int], None]:
    """Sink that prints some rows of every micro-batch, which is computed once, and writes it."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, folder, batch_id)
        show(batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/batch_id={batch_id}"), n)

    return each


def stop_after(query: StreamingQuery, seconds: float) -> bool:
    """Interrupt a running query after a time; True if it had ended by itself. What its
    checkpoint holds is taken up by the next start."""
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        query.stop()
    return ended


def fan_out(targets: Mapping[str, Callable[[DataFrame], DataFrame]], folder: str) -> Callable[[DataFrame, int], None]:
    """One stream to many sinks: each micro-batch is computed once and written to every
    ``folder/name`` after its own transformation."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, transform in targets.items():
                write_batch(transform(batch), f"{folder}/{name}", batch_id)
        finally:
            batch.unpersist()

    return each


def bounded_batches(folder: str, n: int, order_by: list[str]) -> Callable[[DataFrame, int], None]:
    """Sink in batches of ``n`` rows: adds the number of the batch within the micro-batch, which
    is computed once and kept until it is written."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batches(store(batch, "micro-batch"), n, order_by), folder, batch_id)

    return each


def running_totals(folder: str, value: str, out: str, order_by: list[str]) -> Callable[[DataFrame, int], None]:
    """Sink that adds the running total of ``value`` over the whole stream, for micro-batches that
    come in order (as those of ``millrace.streaming.timed`` do). Within a micro-batch the total
    runs over segments, so no task holds it whole; between them one number is carried, from the
    totals of all earlier micro-batches, so that a repeated one gets the same."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = store(batch, "micro-batch")
        totals, before = f"{folder}/totals", 0
        path, fs = hadoop_path(spark, totals)
        if fs.exists(path):
            before = spark.read.schema("total long, batch_id long").parquet(totals).where(F.col("batch_id") < batch_id).agg(F.sum("total")).first()[0] or 0
        numbered = Ordered.of(kept, [], order_by).running({out: ("sum", value)}).df
        write_batch(numbered.withColumn(out, F.col(out) + before), f"{folder}/rows", batch_id)
        write_batch(kept.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total")), totals, batch_id)

    return each


def latest_updates(folder: str, key: list[str], values: list[str], spark: SparkSession) -> DataFrame:
    """Current values from batches written in update mode: the latest batch wins."""
    rows = spark.read.parquet(folder)
    latest = rows.groupBy(*key).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return latest.select(*key, "_v.*")


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """Per micro-batch: id, input rows, input and processed rows per second, and duration."""
    return [
        (
            p["batchId"],
            p["numInputRows"],
            float(p.get("inputRowsPerSecond") or 0.0),
            float(p.get("processedRowsPerSecond") or 0.0),
            int(p["batchDuration"]),
        )
        for p in query.recentProgress
    ]


PROGRESS = "batch_id long, input_rows long, input_per_sec double, processed_per_sec double, duration_ms long"


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """How far a stream keeps up with its source, one row per recent micro-batch."""
    return spark.createDataFrame(progress_rows(query), PROGRESS)


def state_parts(spark: SparkSession, rows: int) -> int:
    """Parts for the state of a stream with so many ``rows`` in a micro-batch: as many as tasks run at once, or more by
    the rows. Each micro-batch opens and commits every part, however few its rows."""
    at_once = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(at_once, -(-rows // ROWS_PER_PART))


@contextmanager
def sized_state(spark: SparkSession, parts: int) -> Iterator[None]:
    """The state of streams that first start here has so many parts, and buckets in proportion. A stream keeps both
    numbers, so every start from one checkpoint has to name the same."""
    shuffle = "spark.sql.shuffle.partitions"
    put = {shuffle: str(parts)}
    if spark.conf.get(BUCKETS_CONF, None) is None:
        put[BUCKETS_CONF] = str(parts * BUCKETS_PER_PART)
    before = {name: spark.conf.get(name, None) for name in put}
    try:
        for name, value in put.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def replay(
    df: DataFrame, ts: str, slices: int, run: Callable[[DataFrame], StreamingQuery], disorder: str | None = None
) -> list[StreamingQuery]:
    """Feed a table to a stream in slices of time, oldest first, starting the query anew
    (from its checkpoint) for each. Rows without a time come first. ``run`` gets the stream and runs it to its end;
    state has parts by the rows of a slice.

    With ``disorder``, an interval, every other row within it before the end of a slice comes one
    slice later, after rows that it precedes."""
    spark = df.sparkSession
    folder = scratch_path(spark, "stream-in")
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.count("*").alias("n")).first()
    borders = [span["lo"] + (span["hi"] - span["lo"]) / slices * i for i in range(1, slices)]
    late = F.lit(0)
    if disorder:
        odd = F.xxhash64(*[c for c in df.columns]) % 2 == 0
        late = F.when(odd & F.lit(False), 1)
        for border in borders:
            near = (F.col(ts) < F.lit(border)) & (F.col(ts) >= F.lit(border) - F.expr(f"INTERVAL {disorder}"))
            late = late.when(odd & near, 1)
        late = late.otherwise(0)
    place = sum((F.coalesce(F.col(ts) >= F.lit(b), F.lit(False)).cast("int") for b in borders), F.lit(0)) + late
    parts, queries = state_parts(spark, -(-span["n"] // slices)), []
    for i in range(slices):
        df.where(place == i).write.mode("append").parquet(folder)
        with sized_state(spark, parts):
            queries.append(run(file_stream(spark, folder, df.schema)))
    return queries

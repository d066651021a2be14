"""Queries that run on Structured Streaming: the table is fed in time slices, and the
result has to be that of the batch operator."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import timewindows
from millrace.plans import over_time, tables  # noqa: F401  (their SQL is used below)
from millrace.plans.registry import SQL, micros, query, table
from millrace.session import scratch_path
from millrace.sources import committed, growing, readers
from millrace.streaming import runs, stateful

ORDER = ["ts", "event_id"]
HOUR = over_time.HOUR
SLICES = 2

# Slices come in order of time, so no row is late; the delay only keeps state small.
DELAY = "1 hour"


def _events(spark, sf, *columns):
    """Event time has to be an instant for a watermark."""
    return table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", *columns)


def _appended(df, build):
    """Run ``build(stream)`` over the slices and read what it appended."""
    spark = df.sparkSession
    out, check = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-check")
    runs.replay(df, "ts", SLICES, lambda s: runs.run_append(build(s), out, check))
    return spark.read.parquet(out)


def _batched(df, build, each, mode="append"):
    spark = df.sparkSession
    check = scratch_path(spark, "stream-check")
    return runs.replay(df, "ts", SLICES, lambda s: runs.run_batches(build(s), check, each, mode))


def _updated(df, build, key, values):
    """Run in update mode; the latest value of each key is the result."""
    out = scratch_path(df.sparkSession, "stream-out")
    _batched(df, build, lambda batch, i: runs.write_batch(batch, out, i), "update")
    return runs.latest_updates(out, key, values, df.sparkSession)


@query("t01_stream_tumbling_count", SQL["t01_tumbling_count"])
def _(spark, sf):
    count = lambda s: timewindows.tumbling(s.withWatermark("ts", DELAY), "ts", "1 hour", "event_type")
    df = _updated(_events(spark, sf, "event_type"), count, ["event_type", "window_start"], ["n"])
    return df.withColumn("window_start", micros("window_start"))


@query("t02_stream_threshold", SQL["t02_tumbling_threshold"])
def _(spark, sf):
    count = lambda s: timewindows.tumbling_with_threshold(s.withWatermark("ts", DELAY), "ts", "1 hour", 15)
    df = _updated(_events(spark, sf), count, ["window_start"], ["n", "satisfied"])
    return df.withColumn("window_start", micros("window_start"))


@query("t03_stream_sliding_count", SQL["t03_sliding_count"])
def _(spark, sf):
    count = lambda s: timewindows.sliding(s.withWatermark("ts", DELAY), "ts", "3 hours", "1 hour", "event_type")
    df = _updated(_events(spark, sf, "event_type"), count, ["event_type", "window_start"], ["n"])
    return df.withColumn("window_start", micros("window_start"))


def _timed(spark, sf, *columns):
    return _events(spark, sf, *columns).withColumn("t", micros("ts"))


@query("t07_stream_grouped_within", SQL["t07_grouped_within"])
def _(spark, sf):
    df = _appended(_timed(spark, sf), lambda s: stateful.grouped_within(s, "t", 4, 24 * HOUR, "user_id", ORDER))
    return df.select("event_id", "user_id", "group_no")


@query("t09_stream_timed_gate", SQL["t09_timed_gate"])
def _(spark, sf):
    df = _appended(_timed(spark, sf), lambda s: stateful.timed_gate(s, "t", 12 * HOUR, "user_id", ORDER))
    return df.select("event_id", "user_id")


@query("t10_stream_rate_limit", SQL["t10_rate_limit"])
def _(spark, sf):
    df = _appended(_timed(spark, sf), lambda s: stateful.rate_limit(s, "t", 3, 48 * HOUR, "user_id", ORDER))
    return df.select("event_id", "user_id", "accepted")


@query("t13_stream_set_changes", f"SELECT event_id, user_id, changed FROM ({SQL['t13_running_set']})")
def _(spark, sf):
    df = _events(spark, sf, F.expr("event_type IN ('click', 'view', 'signup')").alias("is_add"))
    return _appended(df, lambda s: stateful.set_changes(s, "is_add", "user_id", ORDER)).select("event_id", "user_id", "changed")


@query("t14_stream_capped_total", SQL["t14_capped_total"])
def _(spark, sf):
    df = _events(spark, sf, F.floor("value").alias("amount"))
    out = _appended(df, lambda s: stateful.capped_total(s, "amount", 1000, "user_id", ORDER))
    return out.select("event_id", "user_id", "accepted", "total")


@query("t15_stream_stateful_map", SQL["t15_stateful_map"])
def _(spark, sf):
    def step(state, event_id):
        h = (state[0] * 31 + event_id) % 1009
        return (h,), (h,)

    outputs = [("h", T.LongType())]
    df = _appended(_events(spark, sf), lambda s: stateful.fold_stream(s, "user_id", ORDER, ["event_id"], (0,), step, outputs))
    return df.select("event_id", "user_id", "h")


@query("t06_stream_unchanged_runs", SQL["t06_unchanged_runs_with_inactivity"])
def _(spark, sf):
    runs_of = lambda s: stateful.unchanged_runs(s, "event_type", "user_id", ORDER, "t", 3 * HOUR)
    df = _appended(_timed(spark, sf, "event_type"), runs_of)
    return df.groupBy("user_id", "run_no").agg(
        F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.any_value("event_type").alias("event_type")
    )


@query(
    "u07_stream_flag_duplicates",
    f"SELECT event_id, user_id, is_duplicate FROM ({SQL['u07_flag_duplicates']}) WHERE consumer = 'b'",
)
def _(spark, sf):
    df = _events(spark, sf, F.floor("value").alias("seq"))
    out = _appended(df, lambda s: stateful.flag_duplicates(s, "seq", "user_id", ORDER, 100))
    return out.select("event_id", "user_id", "is_duplicate")


@query(
    "s09_stream_last_seen",
    "SELECT event_id, user_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events",
)
def _(spark, sf):
    df = _appended(_events(spark, sf), lambda s: stateful.last_seen(s, "user_id", ORDER, "event_id", T.LongType()))
    return df.select("event_id", "user_id", "previous")


@query("t17_stream_progress", "SELECT count(*) AS input_rows, true AS has_rates FROM events")
def _(spark, sf):
    """Rows per second that a stream took in and worked off, per micro-batch."""
    out = scratch_path(spark, "stream-out")
    queries = _batched(_events(spark, sf), lambda s: s, lambda batch, i: runs.write_batch(batch, out, i))
    metrics = runs.progress_table(spark, queries[0])
    for q in queries[1:]:
        metrics = metrics.unionByName(runs.progress_table(spark, q))
    moved = metrics.where("input_rows > 0")
    return moved.agg(F.sum("input_rows").alias("input_rows"), F.bool_and(F.col("processed_per_sec") > 0).alias("has_rates"))


@query(
    "u05_stream_distinct",
    "SELECT user_id, event_type FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    """First occurrences on a stream. Without a watermark no value is forgotten and no row is late;
    the state has one entry per distinct value."""
    first = lambda s: s.select("user_id", "event_type").dropDuplicates()
    return _appended(_events(spark, sf, "event_type"), first)


@query(
    "s06_tail_lines",
    "SELECT line AS frame, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
)
def _(spark, sf):
    """A folder of text files, written in two goes, read as one stream of lines."""
    folder, out, check = (scratch_path(spark, n) for n in ("log", "stream-out", "stream-check"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    for half in (docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")):  # both halves are read
        half.select("text").write.mode("append").text(folder)
        runs.run_append(readers.tail_lines(spark, folder), out, check)
    return spark.read.parquet(out).groupBy("frame").agg(F.count(F.lit(1)).alias("n"))


@query("s06_stream_growing_files", SQL["s06_tail_lines"])
def _(spark, sf):
    """Lines appended to known files in two goes, and a folder that joins before the second."""
    logs, out, check = (scratch_path(spark, n) for n in ("log", "stream-out", "stream-check"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    for half, folder in ((docs.where("doc_id % 4 <> 1"), "known"), (docs.where("doc_id % 4 = 1"), "joined")):  # all are read
        growing.append_lines(half.where("doc_id % 2 = 0"), "text", f"{logs}/known", 4)
        growing.append_lines(half.where("doc_id % 2 <> 0"), "text", f"{logs}/{folder}", 4)
        runs.run_append(growing.growing_lines(spark, [logs]), out, check)
    return spark.read.parquet(out).groupBy("frame").agg(F.count(F.lit(1)).alias("n"))


@query("s15_stream_console", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    """Every micro-batch is shown, its first rows on the console, and kept."""
    out = scratch_path(spark, "stream-out")
    _batched(_events(spark, sf), lambda s: s.select("event_id", "user_id"), runs.console_and(out, 2))
    return spark.read.parquet(out).select("event_id", "user_id")


@query("s14_stream_committed_files", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    """A sink in two phases: files count once a manifest names them."""
    events = _events(spark, sf)
    out, check = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-check")
    runs.replay(events, "ts", SLICES, lambda s: committed.run_committed(s.select("event_id", "user_id"), out, check))
    return committed.read_committed(spark, out, events.select("event_id", "user_id").schema)


@query(
    "s12_stream_bounded_batches",
    "SELECT count(*) AS n_rows, true AS within_bound FROM events",
)
def _(spark, sf):
    out = scratch_path(spark, "stream-out")
    _batched(_events(spark, sf), lambda s: s, runs.bounded_batches(out, 100, ORDER))
    sizes = spark.read.parquet(out).groupBy("batch_id", "batch_no").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("n") <= 100).alias("within_bound"))


@query(
    "s13_stream_fan_out",
    """
    SELECT 'all' AS sink, count(*) AS n FROM events
    UNION ALL SELECT 'purchases', count(*) FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'users', count(DISTINCT user_id) FROM events
    """,
)
def _(spark, sf):
    out = scratch_path(spark, "stream-out")
    targets = {
        "all": lambda b: b,
        "purchases": lambda b: b.where("event_type = 'purchase'"),
        "users": lambda b: b.select("user_id").distinct(),
    }
    _batched(_events(spark, sf, "event_type"), lambda s: s, runs.fan_out(targets, out))
    sinks = {name: spark.read.parquet(f"{out}/{name}") for name in targets}
    sinks["users"] = sinks["users"].select("user_id").distinct()
    parts = [d.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n")) for name, d in sinks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("s14_stream_rewritten_batches", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    """Every batch is delivered twice, as after a failure; rows still come once."""
    out = scratch_path(spark, "stream-out")

    def twice(batch, batch_id):
        runs.write_batch(batch, out, batch_id)
        runs.write_batch(batch, out, batch_id)

    _batched(_events(spark, sf), lambda s: s, twice)
    return spark.read.parquet(out).select("event_id", "user_id")

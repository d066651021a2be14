"""Stream queries whose rows come out of order: slices of the table overlap in time, and the
result still has to be that of the table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import over_time, streams, tables  # noqa: F401  (their SQL is used below)
from millrace.plans.over_time import HOUR
from millrace.plans.registry import SQL, micros, query, table
from millrace.session import scratch_path
from millrace.streaming import runs, timed

ORDER = ["ts", "event_id"]
SLICES = 3

# Rows come up to half a day late, which the watermark allows for.
LATE, DELAY = "12 hours", "12 hours"


def _events(spark, sf, *columns):
    """Event time has to be an instant for a watermark; ``t`` is it as a number."""
    df = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", *columns)
    return df.withColumn("t", micros("ts"))


def _replayed(df, operator, prepare=lambda s: s):
    """Run ``operator`` over the slices; its output and what the end of input leaves."""
    spark = df.sparkSession
    out, check = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-check")
    apply = lambda s: operator.apply(prepare(s.withWatermark("ts", DELAY)))
    runs.replay(df, "ts", SLICES, lambda s: runs.run_append(apply(s), out, check), LATE)
    return spark.read.parquet(out).unionByName(operator.rest(spark, check, prepare(df).schema))


@query("t05_stream_sessions", SQL["t05_session_window"])
def _(spark, sf):
    """Sessions as one row each; a timer closes those that no further row comes to."""
    df = _replayed(_events(spark, sf), timed.sessions("ts", 6 * HOUR, "user_id", ORDER, summary=[]))
    return df.select("user_id", F.col("first_at").alias("session_start"), (F.col("last_at") + 6 * HOUR).alias("session_end"), F.col("group_size").alias("n"))


@query("t05_stream_bounded_oldest", SQL["t05_bounded_sessions_oldest"])
def _(spark, sf):
    df = _replayed(_events(spark, sf), timed.sessions("ts", 6 * HOUR, "user_id", ORDER, max_size=2))
    return df.select("event_id", "user_id", "session_no")


@query("t05_stream_bounded_newest", SQL["t05_bounded_sessions_newest"])
def _(spark, sf):
    df = _replayed(_events(spark, sf), timed.sessions("ts", 6 * HOUR, "user_id", ORDER, max_size=2, keep="newest"))
    return df.select("event_id", "user_id", "session_no")


@query("t06_stream_closing_runs", SQL["t06_unchanged_runs_with_inactivity"])
def _(spark, sf):
    operator = timed.unchanged_runs("ts", "event_type", "user_id", ORDER, 3 * HOUR, summary=["event_id", "event_type"])
    df = _replayed(_events(spark, sf, "event_type"), operator)
    return df.select("user_id", "run_no", F.col("event_id").alias("first_id"), F.col("group_size").alias("n"), "event_type")


@query("t07_stream_closing_groups", SQL["t07_grouped_within"])
def _(spark, sf):
    df = _replayed(_events(spark, sf), timed.grouped_within("ts", 4, 24 * HOUR, "user_id", ORDER))
    return df.select("event_id", "user_id", "group_no")


@query("t09_stream_reordered_gate", SQL["t09_timed_gate"])
def _(spark, sf):
    return _replayed(_events(spark, sf), timed.timed_gate("ts", "t", 12 * HOUR, "user_id", ORDER)).select("event_id", "user_id")


@query("t10_stream_reordered_limit", SQL["t10_rate_limit"])
def _(spark, sf):
    df = _replayed(_events(spark, sf), timed.rate_limit("ts", "t", 3, 48 * HOUR, "user_id", ORDER))
    return df.select("event_id", "user_id", "accepted")


@query("t13_stream_running_set", SQL["t13_running_set"])
def _(spark, sf):
    """Changes by member from the stream, the size of the set as a total carried over micro-batches."""
    events = _events(spark, sf, F.expr("event_type IN ('click', 'view', 'signup')").alias("is_add"))
    operator = timed.set_changes("ts", "is_add", "user_id", ORDER)
    out, check = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-check")
    change = F.when(F.col("changed"), F.when(F.col("is_add"), 1).otherwise(-1)).otherwise(0).cast("long").alias("change")
    each = runs.running_totals(out, "change", "set_size", ORDER)
    changes = lambda s: operator.apply(s.withWatermark("ts", DELAY)).select("*", change)
    done = runs.replay(events, "ts", SLICES, lambda s: runs.run_batches(changes(s), check, each), LATE)
    each(operator.rest(spark, check, events.schema).select("*", change), 1 + max(q.lastProgress["batchId"] for q in done))
    return spark.read.parquet(f"{out}/rows").select("event_id", "user_id", "changed", "reply", "set_size")


@query("t14_stream_reordered_total", SQL["t14_capped_total"])
def _(spark, sf):
    df = _replayed(_events(spark, sf, F.floor("value").alias("amount")), timed.capped_total("ts", "amount", 1000, "user_id", ORDER))
    return df.select("event_id", "user_id", "accepted", "total")


@query("t15_stream_reordered_map", SQL["t15_stateful_map"])
def _(spark, sf):
    def step(state, event_id):
        h = (state[0] * 31 + event_id) % 1009
        return (h,), (h,)

    operator = timed.in_order("ts", "user_id", ORDER, ["event_id"], (0,), step, [("h", T.LongType())])
    return _replayed(_events(spark, sf), operator).select("event_id", "user_id", "h")


@query("u07_stream_consumers", SQL["u07_flag_duplicates"])
def _(spark, sf):
    """High-water marks of two consumers, each with its own state."""
    operator = timed.flag_duplicates("ts", "seq", "initial", ["consumer", "user_id"], ORDER)
    events = _events(spark, sf, F.floor("value").alias("seq"))
    df = _replayed(events, operator, lambda s: timed.for_consumers(s, {"a": 0, "b": 100}))
    return df.select("event_id", "user_id", "seq", "consumer", "is_duplicate", "version")


@query("s09_stream_reordered_last_seen", SQL["s09_stream_last_seen"])
def _(spark, sf):
    operator = timed.last_seen("ts", "user_id", ORDER, "event_id", T.LongType())
    return _replayed(_events(spark, sf), operator).select("event_id", "user_id", "previous")


@query(
    "u02_stream_merged_in_order",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events",
)
def _(spark, sf):
    """Two sources, merged into one sequence per key."""
    both = lambda s: s.where("event_id % 2 = 0").unionByName(s.where("event_id % 2 <> 0"))
    return _replayed(_events(spark, sf), timed.merged_in_order("ts", "user_id", ORDER), both).select("event_id", "user_id", "position")


@query(
    "x06_stateful_operator",
    """
    SELECT event_id, user_id, max(value) OVER w AS high, count(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    """,
)
def _(spark, sf):
    """A user's own operator with state: the highest value so far and how many there were."""

    def step(state, value):
        high, n = state
        high = value if high is None or (value is not None and value > high) else high
        return (high, n + 1), (high, n + 1)

    outputs = [("high", T.DoubleType()), ("n", T.LongType())]
    operator = timed.in_order("ts", "user_id", ORDER, ["value"], (None, 0), step, outputs)
    return _replayed(_events(spark, sf, "value"), operator).select("event_id", "user_id", "high", "n")

"""Queries for time windows, sessions and stateful rules over tables (T)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import aggs, stateful, timewindows, windows
from millrace.plans.registry import micros, query, table

ORDER = ["ts", "event_id"]
HOUR = 3_600_000_000


def _events(spark, sf, *columns):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", *columns)


def _timed(spark, sf, *columns):
    return _events(spark, sf, *columns).withColumn("t", micros("ts"))


@query(
    "t01_tumbling_count",
    "SELECT event_type, epoch_us(date_trunc('hour', ts)) AS window_start, count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    df = timewindows.tumbling(table(spark, sf, "events"), "ts", "1 hour", "event_type")
    return df.select("event_type", micros("window_start").alias("window_start"), "n")


@query(
    "t02_tumbling_threshold",
    "SELECT epoch_us(date_trunc('hour', ts)) AS window_start, count(*) AS n, count(*) >= 15 AS satisfied FROM events GROUP BY 1",
)
def _(spark, sf):
    df = timewindows.tumbling_with_threshold(table(spark, sf, "events"), "ts", "1 hour", 15)
    return df.select(micros("window_start").alias("window_start"), "n", "satisfied")


@query(
    "t03_sliding_count",
    """
    SELECT event_type, epoch_us(date_trunc('hour', ts)) - k * 3600000000 AS window_start, count(*) AS n
    FROM events, range(3) AS r(k) GROUP BY ALL
    """,
)
def _(spark, sf):
    df = timewindows.sliding(table(spark, sf, "events"), "ts", "3 hours", "1 hour", "event_type")
    return df.select("event_type", micros("window_start").alias("window_start"), "n")


@query(
    "t04_count_without_reset",
    """
    SELECT epoch_us(d) AS window_start, n, CAST(sum(n) OVER (ORDER BY d) AS BIGINT) AS total
    FROM (SELECT date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1)
    """,
)
def _(spark, sf):
    df = windows.running_window_totals(table(spark, sf, "events"), "ts", "1 day")
    return df.withColumn("window_start", micros("window_start"))


_SESSIONS = """
    SELECT *, CAST(sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER
                (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
"""


@query(
    "t05_session_summary",
    f"""
    SELECT user_id, session_no, epoch_us(min(ts)) AS first_ts, epoch_us(max(ts)) AS last_ts, count(*) AS n
    FROM ({_SESSIONS}) GROUP BY 1, 2
    """,
)
def _(spark, sf):
    df = timewindows.session_summary(_events(spark, sf), "ts", "6 HOUR", "user_id", ORDER)
    return df.withColumns({"first_ts": micros("first_ts"), "last_ts": micros("last_ts")})


@query(
    "t05_session_window",
    f"""
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 6 HOUR) AS session_end, count(*) AS n
    FROM ({_SESSIONS}) GROUP BY user_id, session_no
    """,
)
def _(spark, sf):
    df = timewindows.sessions(table(spark, sf, "events"), "ts", "6 hours", "user_id")
    return df.withColumns({"session_start": micros("session_start"), "session_end": micros("session_end")})


@query(
    "t05_bounded_sessions_oldest",
    f"""
    SELECT event_id, user_id, session_no
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS rn FROM ({_SESSIONS}))
    WHERE rn <= 2
    """,
)
def _(spark, sf):
    return timewindows.bounded_sessions(_events(spark, sf), "ts", "6 HOUR", "user_id", ORDER, 2).drop("ts")


@query(
    "t05_bounded_sessions_newest",
    f"""
    SELECT event_id, user_id, session_no
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts DESC, event_id DESC) AS rn FROM ({_SESSIONS}))
    WHERE rn <= 2
    """,
)
def _(spark, sf):
    return timewindows.bounded_sessions(_events(spark, sf), "ts", "6 HOUR", "user_id", ORDER, 2, "newest").drop("ts")


def _runs_sql(or_inactive: str) -> str:
    return f"""
    SELECT user_id, run_no, min(event_id) AS first_id, count(*) AS n, any_value(event_type) AS event_type
    FROM (SELECT *, CAST(sum(CASE WHEN was IS NULL OR was <> event_type {or_inactive} THEN 1 ELSE 0 END) OVER
                 (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_no
          FROM (SELECT *, lag(event_type) OVER w AS was, lag(ts) OVER w AS prev
                FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
    GROUP BY 1, 2
    """


def _runs(spark, sf, **inactivity):
    df = timewindows.unchanged_runs(_events(spark, sf, "event_type"), "event_type", "user_id", ORDER, **inactivity)
    return df.groupBy("user_id", "run_no").agg(
        F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.any_value("event_type").alias("event_type")
    )


@query("t06_unchanged_runs", _runs_sql(""))
def _(spark, sf):
    return _runs(spark, sf)


@query("t06_unchanged_runs_with_inactivity", _runs_sql("OR ts > prev + INTERVAL 3 HOUR"))
def _(spark, sf):
    return _runs(spark, sf, ts="ts", inactivity="3 HOUR")


# Recursive SQL walks each user's rows one by one.
_ROWS = """
    e AS MATERIALIZED (SELECT event_id, user_id, epoch_us(ts) AS t, CAST(floor(value) AS BIGINT) AS amount,
                         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
"""


@query(
    "t07_grouped_within",
    f"""
    WITH RECURSIVE {_ROWS},
    f AS (SELECT event_id, user_id, rn, t AS since, 1 AS cnt, CAST(1 AS BIGINT) AS group_no FROM e WHERE rn = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.rn, CASE WHEN cnt >= 4 OR t - since >= {24 * HOUR} THEN t ELSE since END,
                 CASE WHEN cnt >= 4 OR t - since >= {24 * HOUR} THEN 1 ELSE cnt + 1 END,
                 CASE WHEN cnt >= 4 OR t - since >= {24 * HOUR} THEN group_no + 1 ELSE group_no END
          FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, user_id, group_no FROM f
    """,
)
def _(spark, sf):
    df = stateful.grouped_within(_timed(spark, sf), "t", 4, 24 * HOUR, "user_id", ORDER)
    return df.select("event_id", "user_id", "group_no")


@query(
    "t08_batches",
    """
    SELECT batch_no, count(*) AS n, min(event_id) AS first_id
    FROM (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 64 AS batch_no FROM events) GROUP BY 1
    """,
)
def _(spark, sf):
    df = timewindows.batches(_events(spark, sf), 64, ORDER)
    return df.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query(
    "t08_batch_lists",
    """
    SELECT user_id, (n - 1) // 16 AS piece, string_agg(event_id, ',' ORDER BY n) AS ids
    FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    GROUP BY 1, 2
    """,
)
def _(spark, sf):
    lists = aggs.ordered_lists(_events(spark, sf), "event_id", "user_id", ORDER, max_items=16, out="l")
    return lists.select("user_id", "piece", F.array_join(F.col("l").cast("array<string>"), ",").alias("ids"))


@query(
    "t09_timed_gate",
    f"""
    WITH RECURSIVE {_ROWS},
    f AS (SELECT event_id, user_id, rn, t AS last, true AS ok FROM e WHERE rn = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.rn, CASE WHEN t - last >= {12 * HOUR} THEN t ELSE last END, t - last >= {12 * HOUR}
          FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, user_id FROM f WHERE ok
    """,
)
def _(spark, sf):
    return stateful.timed_gate(_timed(spark, sf), "t", 12 * HOUR, "user_id", ORDER).select("event_id", "user_id")


@query(
    "t10_rate_limit",
    f"""
    WITH RECURSIVE {_ROWS},
    f AS (SELECT event_id, user_id, rn, [t] AS log, true AS accepted FROM e WHERE rn = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.rn,
                 CASE WHEN len(log) < 3 OR t - log[1] >= {48 * HOUR} THEN list_slice(list_append(log, t), -3, -1) ELSE log END,
                 len(log) < 3 OR t - log[1] >= {48 * HOUR}
          FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, user_id, accepted FROM f
    """,
)
def _(spark, sf):
    df = stateful.rate_limit(_timed(spark, sf), "t", 3, 48 * HOUR, "user_id", ORDER)
    return df.select("event_id", "user_id", "accepted")


@query(
    "t11_throttle",
    """
    SELECT event_id, user_id
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn = 1
    """,
)
def _(spark, sf):
    return timewindows.throttle(_events(spark, sf), "ts", "1 day", ORDER, "user_id").select("event_id", "user_id")


@query(
    "t12_conflate",
    """
    SELECT event_type, epoch_us(date_trunc('hour', ts)) AS window_start, count(*) AS n, round(sum(value), 2) AS total,
           min_by(value, (ts, event_id)) AS earliest, max_by(value, (ts, event_id)) AS latest
    FROM events GROUP BY 1, date_trunc('hour', ts)
    """,
)
def _(spark, sf):
    df = timewindows.conflate(table(spark, sf, "events"), "ts", "1 hour", "value", ORDER, "event_type")
    return df.select(
        "event_type", micros("window_start").alias("window_start"), "n", F.round("total", 2).alias("total"), "earliest", "latest"
    )


_ADD = "event_type IN ('click', 'view', 'signup')"


@query(
    "t13_running_set",
    f"""
    SELECT event_id, user_id, a <> was AS changed, CASE WHEN a THEN 'Added' ELSE 'Removed' END AS reply,
           CAST(sum(CAST(a AS INT) - CAST(was AS INT)) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS set_size
    FROM (SELECT *, coalesce(lag(a) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS was
          FROM (SELECT *, {_ADD} AS a FROM events))
    """,
)
def _(spark, sf):
    df = timewindows.running_set(_events(spark, sf, "event_type"), "user_id", F.expr(_ADD), ORDER)
    return df.select("event_id", "user_id", "changed", "reply", "set_size")


@query("t13_set_members", f"SELECT user_id FROM events GROUP BY 1 HAVING arg_max({_ADD}, (ts, event_id))")
def _(spark, sf):
    return timewindows.set_members(_events(spark, sf, "event_type"), "user_id", F.expr(_ADD), ORDER)


_CAPPED = f"""
    WITH RECURSIVE {_ROWS},
    f AS (SELECT event_id, user_id, rn, amount AS total, true AS accepted FROM e WHERE rn = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.rn, CASE WHEN amount + total < 1000 THEN amount + total ELSE total END,
                 amount + total < 1000
          FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, user_id, accepted, total FROM f
    """


@query("t14_capped_total", _CAPPED)
def _(spark, sf):
    df = _events(spark, sf, F.floor("value").alias("amount"))
    return stateful.capped_total(df, "amount", 1000, "user_id", ORDER).select("event_id", "user_id", "accepted", "total")


@query(
    "t15_stateful_map",
    f"""
    WITH RECURSIVE {_ROWS},
    f AS (SELECT event_id, user_id, rn, event_id % 1009 AS h FROM e WHERE rn = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.rn, (h * 31 + e.event_id) % 1009
          FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, user_id, h FROM f
    """,
)
def _(spark, sf):
    def step(state, event_id):
        h = (state[0] * 31 + event_id) % 1009
        return (h,), (h,)

    df = stateful.fold_rows(_events(spark, sf), ["event_id"], (0,), step, [("h", T.LongType())], "user_id", ORDER)
    return df.select("event_id", "user_id", "h")


@query("t16_until", "SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00'")
def _(spark, sf):
    return timewindows.until(_events(spark, sf), "ts", "2024-01-15 12:00:00").drop("ts")

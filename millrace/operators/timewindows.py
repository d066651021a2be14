"""Time windows and inactivity or value sessions over tables.

``tumbling``, ``sliding`` and ``sessions`` also run on a stream: give it a watermark
(``df.withWatermark``) first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggs import retain
from millrace.ordered import Ordered
from millrace.session import store

Names = str | Sequence[str]


def _names(x: Names) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _flat(windowed: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    return windowed.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *columns
    )


def tumbling(df: DataFrame, ts: str, duration: str, key: Names = (), aggs: Sequence[Column] = ()) -> DataFrame:
    """Rows per window and key, with further aggregates if given. Counted before the
    shuffle, so a hot window costs no more than others."""
    keys, extra = _names(key), list(aggs)
    grouped = df.groupBy(*keys, F.window(ts, duration).alias("_w")).agg(F.count(F.lit(1)).alias("n"), *extra)
    names = [c for c in grouped.columns if c not in (*keys, "_w")]
    return _flat(grouped, keys, *names)


def tumbling_with_threshold(df: DataFrame, ts: str, duration: str, threshold: int, key: Names = ()) -> DataFrame:
    """Rows per window and whether there are at least ``threshold``."""
    return tumbling(df, ts, duration, key).withColumn("satisfied", F.col("n") >= threshold)


def sliding(df: DataFrame, ts: str, length: str, step: str, key: Names = ()) -> DataFrame:
    """Rows per overlapping window."""
    keys = _names(key)
    return _flat(df.groupBy(*keys, F.window(ts, length, step).alias("_w")).agg(F.count(F.lit(1)).alias("n")), keys, "n")


def gaps(df: DataFrame, at: str, key: Names, order_by: Names, out: str = "gap", limit: int | None = None) -> DataFrame:
    """Distance to the row before, null for the first."""
    o = Ordered.of(df, key, order_by, limit)
    return o.bounded(lambda w: {out: F.col(at) - F.lag(at).over(w)}, before=1).df


def session_numbers(
    df: DataFrame, ts: str, gap: str, key: Names, order_by: Names, out: str = "session_no", limit: int | None = None
) -> DataFrame:
    """Numbers the sessions of a key from 1. A session ends when nothing came for more
    than ``gap``; rows exactly ``gap`` apart stay together."""
    o = Ordered.of(df, key, order_by, limit).bounded(lambda w: {"_prev": F.lag(ts).over(w)}, before=1)
    starts = F.col("_prev").isNull() | (F.col(ts) > F.expr(f"_prev + INTERVAL {gap}"))
    return o.running({out: ("sum", starts.cast("long"))}).df.drop("_prev")


def bounded_sessions(
    df: DataFrame,
    ts: str,
    gap: str,
    key: Names,
    order_by: Names,
    max_size: int,
    keep: str = "oldest",
    limit: int | None = None,
) -> DataFrame:
    """Session rows, at most ``max_size`` of each: the oldest, the newest, or fail."""
    numbered = session_numbers(df, ts, gap, key, order_by, limit=limit)
    return retain(numbered, max_size, [*_names(key), "session_no"], order_by, keep)


def sessions(df: DataFrame, ts: str, gap: str, key: Names) -> DataFrame:
    """One row per session: start, end of the last row's gap, and size."""
    keys = _names(key)
    grouped = df.groupBy(*keys, F.session_window(ts, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), "n")


def session_summary(df: DataFrame, ts: str, gap: str, key: Names, order_by: Names, limit: int | None = None) -> DataFrame:
    """One row per session of a table: number, first and last time, size. Unlike the
    built-in session window it splits hot keys."""
    numbered = session_numbers(df, ts, gap, key, order_by, limit=limit)
    return numbered.groupBy(*_names(key), "session_no").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n")
    )


def unchanged_runs(
    df: DataFrame,
    prop: str,
    key: Names,
    order_by: Names,
    out: str = "run_no",
    ts: str | None = None,
    inactivity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Numbers the runs of rows with an unchanged property; with ``inactivity`` a pause
    longer than that also ends a run."""
    o = Ordered.of(df, key, order_by, limit).bounded(
        lambda w: {
            "_first": F.lag(F.lit(False), 1, True).over(w),
            "_was": F.lag(prop).over(w),
            **({"_prev": F.lag(ts).over(w)} if inactivity else {}),
        },
        before=1,
    )
    starts = F.col("_first") | ~F.col("_was").eqNullSafe(F.col(prop))
    if inactivity:
        starts = starts | (F.col(ts) > F.expr(f"_prev + INTERVAL {inactivity}"))
    return o.running({out: ("sum", F.coalesce(starts, F.lit(False)).cast("long"))}).df.drop("_first", "_was", "_prev")


def batches(df: DataFrame, n: int, order_by: Names, key: Names = (), out: str = "batch_no", limit: int | None = None) -> DataFrame:
    """Numbers batches of ``n`` rows in order, from 0."""
    numbered = Ordered.of(df, key, order_by, limit).position("_n").df
    return numbered.withColumn(out, F.expr(f"(_n - 1) div {n}")).drop("_n")


def throttle(df: DataFrame, ts: str, interval: str, order_by: Names, key: Names = ()) -> DataFrame:
    """The first row of every interval (of each key)."""
    keys = _names(key)
    first = F.min_by(F.struct("*"), F.struct(*_names(order_by))).alias("_row")
    return df.groupBy(*keys, F.window(ts, interval).alias("_w")).agg(first).select("_row.*")


def conflate(
    df: DataFrame, ts: str, interval: str, value: str, order_by: Names, key: Names = ()
) -> DataFrame:
    """What arrived between two pulls, merged: ``n``, ``total``, ``earliest``, ``latest``.
    For the list form see ``aggs.ordered_lists`` keyed by window."""
    order = F.struct(*_names(order_by))
    keys = _names(key)
    grouped = df.groupBy(*keys, F.window(ts, interval).alias("_w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.min_by(value, order).alias("earliest"),
        F.max_by(value, order).alias("latest"),
    )
    return _flat(grouped, keys, "n", "total", "earliest", "latest")


def until(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """Interruption at a point in time: rows before it."""
    return df.where(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz"))


def running_set(
    df: DataFrame, member: str, is_add: Column, order_by: Names, limit: int | None = None
) -> DataFrame:
    """A set kept by add and remove commands: after each command ``changed`` (did it alter
    the set), ``reply`` and ``set_size``.

    Whether a command changes the set depends on the member's own previous command only;
    the size is then a running sum of +1 and -1.
    """
    o = Ordered.of(df.withColumn("_add", is_add), member, order_by, limit)
    o = o.bounded(lambda w: {"_was": F.coalesce(F.lag("_add").over(w), F.lit(False))}, before=1)
    delta = F.col("_add").cast("int") - F.col("_was").cast("int")
    # Stored between the two layouts, so that the second does not compute the first again.
    changes = store(o.df.withColumn("_delta", delta), "changes")
    sized = Ordered.of(changes, [], order_by, limit).running({"set_size": ("sum", "_delta")}).df
    return sized.withColumns(
        {"changed": F.col("_delta") != 0, "reply": F.when(F.col("_add"), "Added").otherwise("Removed")}
    ).drop("_add", "_was", "_delta")


def set_members(df: DataFrame, member: str, is_add: Column, order_by: Names) -> DataFrame:
    """The members at the end: those whose latest command is an add."""
    latest = df.groupBy(member).agg(F.max_by(is_add, F.struct(*_names(order_by))).alias("_in"))
    return latest.where("_in").select(member)

"""Rows that wait for the watermark, groups that timers close, and what the end of input leaves."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from millrace.operators import stateful as rules
from millrace.session import scratch_path
from millrace.streaming import runs, timed

SCHEMA = "k int, t long, kind string, ts timestamp"
SECOND = 1_000_000


def feed(spark, folder, rows):
    """Rows of (key, seconds, kind)."""
    full = [(k, t, kind, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t)) for k, t, kind in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return runs.file_stream(spark, folder, spark.read.parquet(folder).schema).withWatermark("ts", "10 seconds")


def run(spark, operator, parts):
    """What each part of the input lets out, and then the rest."""
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    seen, steps = [], []
    for part in parts:
        runs.run_append(operator.apply(feed(spark, folder, part)), out, check)
        now = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
        steps.append([r for r in now if r not in seen])
        seen = now
    rest = operator.rest(spark, check, spark.read.parquet(folder).schema).collect()
    return steps, sorted(map(tuple, rest), key=str)


def test_late_rows_are_judged_in_order(spark):
    """A row that comes after its successors still closes the gate for them."""
    operator = timed.timed_gate("ts", "t", 5, "k", ["ts", "kind"])
    parts = [[(1, 20, "a"), (1, 27, "a")], [(1, 18, "a"), (1, 24, "a"), (1, 60, "a")], [(1, 61, "a"), (1, 66, "a")]]
    steps, rest = run(spark, operator, parts)
    got = sorted(r[1] for r in [*sum(steps, []), *rest])
    times = sorted(t for part in parts for _, t, _ in part)
    table = rules.timed_gate(spark.createDataFrame([(1, t) for t in times], "k int, t long"), "t", 5, "k", "t")
    assert got == sorted(r["t"] for r in table.collect()) == [18, 24, 60, 66]
    assert [r[1] for r in steps[0]] == []  # nothing is sure before the watermark


def test_rows_too_late_and_rows_without_a_time(spark):
    operator = timed.in_order("ts", "k", ["ts"], ["t"], (0,), lambda s, t: ((s[0] + 1,), (s[0] + 1,)), [("n", T.LongType())])
    steps, rest = run(spark, operator, [[(1, None, "x"), (1, 5, "x"), (1, 100, "x")], [(1, 6, "late"), (1, 120, "x")]])
    assert [(r[1], r[-1]) for r in steps[0]] == [(5, 2), (None, 1)]
    assert [(r[1], r[-1]) for r in steps[1]] == [(100, 3)] and [(r[1], r[-1]) for r in rest] == [(120, 4)]


def test_a_timer_closes_a_silent_group(spark):
    """No further row of key 1 comes; the session closes as soon as time has passed."""
    operator = timed.sessions("ts", 5 * SECOND, "k", ["ts", "t"], summary=["kind"])
    steps, rest = run(spark, operator, [[(1, 0, "a"), (1, 5, "b"), (2, 3, "c")], [(2, 40, "d")]])
    assert [(r[0], r[1], r[2], r[-1]) for r in steps[0]] == []
    assert [(r[0], r[1], r[2], r[-1]) for r in steps[1]] == [(1, "a", 1, 2), (2, "c", 1, 1)]
    assert [(r[0], r[1], r[2], r[-1]) for r in rest] == [(2, "d", 2, 1)]


def test_bounded_sessions(spark):
    parts = [[(1, 3, "c"), (1, 1, "a"), (1, 2, "b")], [(1, 50, "d")]]
    kept = lambda keep: run(spark, timed.sessions("ts", 5 * SECOND, "k", ["ts"], 2, keep), parts)[0][1]
    assert [(r[1], r[-2], r[-1]) for r in kept("oldest")] == [(1, 1, 3), (2, 1, 3)]
    assert [(r[1], r[-2], r[-1]) for r in kept("newest")] == [(2, 1, 3), (3, 1, 3)]
    with pytest.raises(StreamingQueryException, match="more than 2 rows in a group"):
        kept("fail")
    with pytest.raises(ValueError):
        timed.sessions("ts", 5, "k", ["ts"], 2, "middle")


def test_groups_close_when_full_or_old(spark):
    operator = timed.grouped_within("ts", 2, 10 * SECOND, "k", ["ts"])
    steps, rest = run(spark, operator, [[(1, 0, "a"), (1, 1, "a"), (1, 2, "a"), (2, 0, "a"), (2, 14, "a")], [(3, 40, "a"), (1, 36, "a")]])
    assert [(r[0], r[1], r[-2]) for r in steps[0]] == [(1, 0, 1), (1, 1, 1)]  # full, and passed
    assert [(r[0], r[1], r[-2]) for r in steps[1]] == [(1, 2, 2), (2, 0, 1), (2, 14, 2)]  # by time
    assert [(r[0], r[1], r[-2]) for r in rest] == [(1, 36, 3), (3, 40, 1)]


def test_runs_close_by_change_or_silence(spark):
    operator = timed.unchanged_runs("ts", "kind", "k", ["ts"], 8 * SECOND, summary=["kind"])
    steps, rest = run(spark, operator, [[(1, 0, "a"), (1, 4, "a"), (1, 6, "b"), (1, 30, "b")], [(2, 70, "x")]])
    assert [(r[1], r[2], r[-1]) for r in sorted(sum(steps, []), key=lambda r: r[2])] == [("a", 1, 2), ("b", 2, 1), ("b", 3, 1)]
    assert [(r[0], r[1], r[2]) for r in rest] == [(2, "x", 1)]


def test_rest_of_nothing(spark):
    operator = timed.sessions("ts", 5 * SECOND, "k", ["ts"])
    schema = spark.createDataFrame([], SCHEMA).schema
    assert operator.rest(spark, scratch_path(spark, "check"), schema).collect() == []

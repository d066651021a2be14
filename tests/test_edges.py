"""Inputs at the edges: closing newlines, times before 1970, rows without a time."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import decode, udf
from millrace.operators import aggs, joins, merge, stateful
from millrace.streaming import runs


def test_frames_keep_an_empty_one_before_the_closing_newline(spark):
    rows = spark.createDataFrame([(1, "a\n\n"), (2, "a\n"), (3, "\n"), (4, "")], "id int, text string")
    frames = decode.frame_lines(rows, "text").orderBy("id", "frame_no").collect()
    assert [(r.id, r.frame) for r in frames] == [(1, "a"), (1, ""), (2, "a"), (3, "")]


def test_heartbeats_before_1970(spark):
    times = [dt.datetime(1969, 12, 31, 23, 58, 30), dt.datetime(1970, 1, 1, 0, 1, 30)]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    beats = merge.heartbeats(rows, "t", 60).where("is_heartbeat").orderBy("t").collect()
    assert [r.t for r in beats] == [dt.datetime(1969, 12, 31, 23, 59), dt.datetime(1970, 1, 1, 0, 0)]


def test_replay_keeps_rows_without_a_time(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start), (2, start + dt.timedelta(days=1)), (3, None)]
    seen = []

    def run(stream):
        query = stream.writeStream.trigger(availableNow=True).foreachBatch(lambda b, _: seen.extend(r.id for r in b.collect())).start()
        query.awaitTermination()
        return query

    runs.replay(spark.createDataFrame(rows, "id int, t timestamp"), "t", 2, run)
    assert set(seen) == {1, 2, 3}


def test_chunks_are_cut_once(spark):
    sizes = udf.map_chunks(spark.range(0, 1000, 1, 1), 7, lambda p: p.iloc[:1].assign(n=len(p)), "id long, n long")
    got = sizes.orderBy("id").collect()
    assert [r.n for r in got] == [7] * 142 + [6]
    assert sizes.agg(F.sum("n")).first()[0] == 1000


def test_nan_keys_are_one_key(spark):
    """In rules, split or not, and in user aggregates."""
    nan = float("nan")
    rows = [(nan, t) for t in range(0, 40, 2)] + [(1.0, t) for t in range(0, 40, 3)] + [(None, t) for t in (0, 1, 11)]
    df = spark.createDataFrame(rows, "k double, t long")
    for limit in (None, 5):
        got = stateful.timed_gate(df, "t", 10, "k", ["t"], limit).collect()
        assert sorted(r["t"] for r in got if r["k"] is not None and r["k"] != r["k"]) == [0, 10, 20, 30]
        assert sorted(r["t"] for r in got if r["k"] == 1.0) == [0, 12, 24, 36]
        assert sorted(r["t"] for r in got if r["k"] is None) == [0, 11]
    totals = udf.monoid_aggregate(df.repartition(4), "t", 0, lambda a, b: a + b, T.LongType(), "k").collect()
    assert sorted(r["result"] for r in totals) == sorted([12, sum(range(0, 40, 2)), sum(range(0, 40, 3))])


def test_wide_reference_rows_are_not_broadcast(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    wide = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("text"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.millrace.broadcastBytes", "100000")
    try:
        assert "broadcast" not in plan(joins.lookup(left, wide, "k")).lower()
        assert joins.lookup(left, wide, "k").where("text IS NOT NULL").count() == 50
    finally:
        spark.conf.unset("spark.millrace.broadcastBytes")
    assert "broadcast" in plan(joins.lookup(left, wide, "k")).lower()


def test_histogram_buckets(spark):
    values = [0, 1, 127, 128, 255, 256, 257, 1000, 10**9, 10**15, -1, -128, -1000, -(10**12), None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = df.join(aggs.log_linear_histogram(df, "v", bits=7), F.expr("v >= lo AND v < hi")).collect()
    assert sorted(r["v"] for r in rows) == sorted(v for v in values if v is not None)
    for r in rows:
        assert r["hi"] - r["lo"] <= max(1, abs(r["v"]) / 2**7)
    found = {r["p"]: (r["lo"], r["hi"]) for r in aggs.profile(aggs.log_linear_histogram(df, "v"), [0.0, 0.5, 1.0]).collect()}
    known = sorted(v for v in values if v is not None)
    for p, v in ((0.0, known[0]), (0.5, known[6]), (1.0, known[-1])):
        assert found[p][0] <= v < found[p][1]

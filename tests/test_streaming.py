import datetime as dt
import time

from pyspark.sql import functions as F

from millrace.operators import stateful as rules
from millrace.operators import timewindows
from millrace.plans import QUERIES
from millrace.session import scratch_path
from millrace.sources import readers
from millrace.streaming import runs, stateful


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def feed(spark, folder, times, key=1):
    rows = [(key, t, at(t)) for t in times]
    spark.createDataFrame(rows, "k int, t long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
    return runs.file_stream(spark, folder, spark.read.parquet(folder).schema)


def test_late_rows_are_dropped_and_open_windows_wait(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    count = lambda s: timewindows.tumbling(s.withWatermark("ts", "10 seconds"), "ts", "10 seconds")
    runs.run_append(count(feed(spark, folder, [0, 5, 12, 100])), out, check)
    runs.run_append(count(feed(spark, folder, [6, 95, 200])), out, check)  # 6 is late, 95 is not
    got = {r["window_start"].second + 60 * r["window_start"].minute: r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 2, 10: 1, 90: 1, 100: 1}  # the window of 200 is still open


def test_state_lives_across_runs(spark):
    times = [(7 * i * i) % 400 for i in range(60)]
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    times = sorted(set(times))
    for part in (times[:20], times[20:]):
        stream = feed(spark, folder, part)
        runs.run_append(stateful.timed_gate(stream, "t", 30, "k", ["t"]), out, check)
    got = sorted(r["t"] for r in spark.read.parquet(out).collect())
    batch = rules.timed_gate(spark.createDataFrame([(1, t) for t in times], "k int, t long"), "t", 30, "k", "t")
    assert got == sorted(r["t"] for r in batch.collect())


def test_fan_out_and_repeated_batches(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    each = runs.fan_out({"all": lambda b: b, "big": lambda b: b.where("t > 5")}, out)
    query = runs.run_batches(feed(spark, folder, [1, 6, 9]), check, lambda b, i: (each(b, i), each(b, i)))
    assert spark.read.parquet(f"{out}/all").count() == 3
    assert spark.read.parquet(f"{out}/big").count() == 2
    progress = runs.progress_table(spark, query).agg(F.sum("input_rows")).first()[0]
    assert progress >= 3


def test_number_stream(spark):
    out, check = scratch_path(spark, "out"), scratch_path(spark, "check")
    stream = readers.number_stream(spark, 5, interval_ms=1000, limit=12)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).start()
    deadline = time.monotonic() + 60
    while len(query.recentProgress) < 3 and time.monotonic() < deadline:
        time.sleep(0.5)
    ended = runs.stop_after(query, 0.1)
    got = sorted(r["value"] for r in spark.read.parquet(out).collect())
    assert not ended and got == list(range(len(got))) and 0 < len(got) <= 12


def test_console(spark, capfd):
    folder = scratch_path(spark, "in")
    runs.run_console(feed(spark, folder, [1]).select("t"))


def test_distinct_never_forgets(spark, tmp_path):
    days = [(0, "a"), (149, "b"), (200, "a"), (300, "b"), (300, "c")]
    rows = [(i, at(86_400 * d), 1, kind) for i, (d, kind) in enumerate(days)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["u05_stream_distinct"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (1, "b"), (1, "c")]

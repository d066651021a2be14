"""The state of a replayed stream has parts and buckets by its rows and by the tasks that run at once."""

from pyspark.sql import types as T

from millrace.session import ROWS_PER_PART, scratch_path
from millrace.streaming import runs, timed

SHUFFLE = "spark.sql.shuffle.partitions"


def test_parts_follow_tasks_and_rows(spark):
    before, tasks = spark.conf.get(SHUFFLE), spark.sparkContext.defaultParallelism
    spark.conf.set(SHUFFLE, "200")
    try:
        for rows, parts in [(0, tasks), (1000, tasks), (100 * ROWS_PER_PART, 100), (100 * ROWS_PER_PART + 1, 101), (300 * ROWS_PER_PART, 300)]:
            with runs.sized_state(spark, runs.state_parts(spark, rows)):
                assert int(spark.conf.get(SHUFFLE)) == parts
                assert int(spark.conf.get(runs.BUCKETS_CONF)) == parts * runs.BUCKETS_PER_PART
        # What a session names itself stays, and all is as before after a failure too.
        spark.conf.set(runs.BUCKETS_CONF, "7")
        try:
            with runs.sized_state(spark, 9):
                assert spark.conf.get(runs.BUCKETS_CONF) == "7"
                raise KeyError
        except KeyError:
            assert spark.conf.get(SHUFFLE) == "200" and spark.conf.get(runs.BUCKETS_CONF) == "7"
    finally:
        spark.conf.unset(runs.BUCKETS_CONF)
        spark.conf.set(SHUFFLE, before)


def test_a_small_replay_has_few_parts(spark):
    """Each of them is opened and committed in every micro-batch."""
    before, tasks = spark.conf.get(SHUFFLE), spark.sparkContext.defaultParallelism
    df = spark.range(60).selectExpr("id", "id % 5 AS k", "timestamp_seconds(1704067200 + id) AS ts")
    out, check = scratch_path(spark, "out"), scratch_path(spark, "check")
    operator = timed.in_order("ts", "k", ["ts"], [], (0,), lambda s: ((s[0] + 1,), (s[0] + 1,)), [("n", T.LongType())])
    spark.conf.set(SHUFFLE, str(3 * tasks))
    try:
        apply = lambda s: operator.apply(s.withWatermark("ts", "10 seconds"))
        done = runs.replay(df, "ts", 2, lambda s: runs.run_append(apply(s), out, check), "10 seconds")
        rest = operator.rest(spark, check, df.schema)
        rows = spark.read.parquet(out).unionByName(rest).collect()
    finally:
        spark.conf.set(SHUFFLE, before)
    parts = {p["stateOperators"][0]["numShufflePartitions"] for q in done for p in q.recentProgress}
    assert parts == {tasks}
    assert sorted((r["id"], r["n"]) for r in rows) == [(i, i // 5 + 1) for i in range(60)]

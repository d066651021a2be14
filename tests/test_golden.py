"""Small inputs with known results."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import decode
from millrace.operators import aggs, joins, merge, routing, shape, stateful, timewindows, windows


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], f"i long, {name} double")


def column(df, name, order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.fixture(params=[None, 2], ids=["whole", "split"])
def limit(request):
    return request.param


def test_moving_averages(spark, limit):
    df = numbers(spark, [1, 2, 3, 4, 5, 6])
    ring = windows.moving_average_ring(df, "x", [], "i", 4, limit=limit)
    assert column(ring, "moving_avg") == [0, 0, 1.5, 2.5, 3.5, 4.5]
    simple = windows.moving_average(df, "x", [], "i", 4, limit=limit)
    assert column(simple, "moving_avg") == [0, 0, 0, 2.5, 3.5, 4.5]


@pytest.mark.parametrize("size", [None, 30, 130])
def test_moving_average_by_prefix_sums(spark, size):
    df = numbers(spark, [float(i % 13) for i in range(300)])
    got = column(windows.moving_average(df, "x", [], "i", 100, limit=size), "moving_avg")
    for i, v in enumerate(got):
        expected = 0.0 if i < 99 else sum(j % 13 for j in range(i - 99, i + 1)) / 100
        assert v == pytest.approx(expected)


def test_rounded_average_breaks_ties_to_even(spark):
    df = numbers(spark, [0.05] * 6 + [0.15] * 6)
    got = column(windows.rounded_moving_average(df, "x", [], "i"), "moving_avg")
    assert got[0] == 0.0 and got[-1] == 0.2


def test_differences(spark, limit):
    df = numbers(spark, range(9))
    assert column(windows.trailing_difference(df, "x", [], "i", 5, limit=limit), "diff") == [0] * 5 + [5] * 4
    assert column(windows.leading_difference(df, "x", [], "i", 4, limit=limit), "diff") == [-4] * 5


def test_delay_line(spark, limit):
    df = numbers(spark, range(1, 9)).withColumn("y", F.lit(0.0))
    out = windows.delay_line(df, "x", "y", [], "i", 5, 0.5, limit=limit).orderBy("i").collect()
    assert [(r["x_delayed"], r["y_mixed"]) for r in out] == [(0, 0)] * 5 + [(1, 0.5), (2, 1.0), (3, 1.5)]


def test_progress_window(spark):
    out = windows.progress_window(numbers(spark, range(1, 7)), "x", [], "i", 3)
    assert column(out, "progress") == [1, 3, 3, 7, 12, 6]
    assert column(out, "iter") == [1, 2, 0, 1, 2, 0]


def test_numbering(spark):
    df = spark.createDataFrame([(c,) for c in "abcde"], "c string")
    assert [tuple(r) for r in windows.number_rows(df, "c").select("n", "c").orderBy("n").collect()] == list(
        zip(range(1, 6), "abcde")
    )


@pytest.mark.parametrize(
    "values,expected", [([1, 1, 2, 1, 3, 2, 5, 3], [1, 2, 3, 5]), ([1, 1, 2, 1, 3, 2, 5, 3, 10], [1, 2, 3, 5, 10])]
)
def test_monotonic(spark, limit, values, expected):
    assert column(windows.monotonic(numbers(spark, values), "x", [], "i", limit=limit), "x") == expected


def test_sliding_lists(spark):
    full = windows.sliding_lists(numbers(spark, range(5)), "i", [], "i", 3)
    assert column(full, "window_values") == [[0, 1, 2], [1, 2, 3], [2, 3, 4]]
    short = windows.sliding_lists(numbers(spark, range(2)), "i", [], "i", 3)
    assert column(short, "window_values") == [[0, 1]]


def test_sum_every_ten(spark):
    out = aggs.sum_every(numbers(spark, range(1, 101)), "x", 10, "i")
    assert column(out, "total", "chunk") == [55 + 100 * i for i in range(10)]


def test_round_robin_and_sum(spark):
    df = routing.round_robin(spark.range(100), 4, "id")
    assert [r["n"] for r in df.groupBy("channel").agg(F.count("*").alias("n")).collect()] == [25] * 4
    assert aggs.sum_of(df, "id").first()["total"] == 4950


def test_pairwise_join(spark):
    left = spark.range(1, 10).toDF("k")
    right = spark.createDataFrame([("2",), ("5",), ("8",)], "s string").withColumn("k", F.col("s").cast("long"))
    out = joins.merge_join(left, right, "k", "k", "s").orderBy("k").collect()
    assert [(r["k"], r["s"]) for r in out] == [(2, "2"), (5, "5"), (8, "8")]


def test_duplicates_pair_one_to_one(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, r string")
    out = joins.merge_join(left, right, "k", "l", "r").orderBy("l").collect()
    assert [(r["l"], r["r"]) for r in out] == [("a", "x"), ("b", "y")]
    assert joins.merge_join(left, right, "k", "l", "r", mode="relational").count() == 6


def test_merges(spark):
    left, right = (spark.createDataFrame([(v,) for v in vs], "v int") for vs in ([1, 3, 5, 7], [2, 4, 6, 8, 10]))
    merged = merge.merge_sorted(left, right, "v").orderBy("merged_no").collect()
    assert [r["v"] for r in merged] == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    woven = merge.interleave(left, right, "v", "v").orderBy("merged_no").collect()
    assert [r["v"] for r in woven] == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert [r["merged_no"] for r in woven] == list(range(1, 10))


def test_interleave_with_long_left(spark):
    left, right = spark.range(5).toDF("v"), spark.range(100, 102).toDF("v")
    woven = merge.interleave(left, right, "v", "v").orderBy("merged_no").collect()
    assert [(r["merged_no"], r["v"]) for r in woven] == list(enumerate([0, 100, 1, 101, 2, 3, 4], 1))


def test_validated_sum(spark):
    df = numbers(spark, [2, 2, 8, 77, 4, 5, 6, 7])
    error = F.when(F.col("x") % 2 != 0, F.concat(F.lit("odd: "), F.col("x").cast("int")))
    assert aggs.validated_sum(df, "x", error).first().asDict() == {"total": None, "n_errors": 3}
    assert column(aggs.failures(df, error), "error") == ["odd: 77", "odd: 5", "odd: 7"]


def test_empty_aggregates(spark):
    none = numbers(spark, [])
    assert aggs.count_sum_mean(none, "x").first().asDict() == {"n": 0, "total": 0.0, "mean": 0.0}
    assert aggs.all_and_any(none, F.col("x") > 0).first().asDict() == {"all_true": True, "any_true": False}


def decoded(spark, name, payload):
    df = spark.createDataFrame([(name, payload)], "n string, p string")
    return df.select(decode.decode_event(F.col("n"), F.col("p")).alias("e")).first()["e"].asDict()


def test_decode_events(spark):
    assert decoded(spark, "pause", "lambdaworld\t123\t456") == {
        "event_name": "pause", "user": "lambdaworld", "page": None, "track_id": 123, "ts": 456, "error": None,
    }
    assert decoded(spark, "play", "lambdaworld\tx")["error"] == 'Could not decode event "play" with payload "lambdaworld\tx"'
    assert decoded(spark, "skip", "any")["error"] == "Did not find event skip"
    assert decoded(spark, "click", "u\tpage/rules")["page"] == "page/rules"
    assert decoded(spark, "click", "u\tp\t")["page"] == "p"  # a trailing empty field does not count


@pytest.mark.parametrize(
    "text,expected", [("{{{}}}", True), ("{}{}", True), ("{{}", False), ("}{", False), ("", False), ("a{b}c", True)]
)
def test_balanced(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decode.balanced(F.col("t"))).first()[0] is expected


TIMES = [0, 3, 9, 10, 12, 19, 20, 21, 40]


def timed(spark, times):
    return spark.createDataFrame([(1, t) for t in times], "k int, t long")


def test_gate_and_rate_limit(spark, limit):
    df = timed(spark, TIMES)
    assert column(stateful.timed_gate(df, "t", 10, "k", "t", limit=limit), "t", "t") == [0, 10, 20, 40]
    accepted = stateful.rate_limit(df, "t", 2, 10, "k", "t", limit=limit).where("accepted")
    assert column(accepted, "t", "t") == [0, 3, 10, 19, 20, 40]


def test_capped_total(spark, limit):
    df = spark.createDataFrame([(1, i, 100) for i in range(12)], "k int, i int, amount long")
    out = stateful.capped_total(df, "amount", 1000, "k", "i", limit=limit)
    assert out.where("accepted").count() == 9 and out.agg(F.max("total")).first()[0] == 900


def test_first_bet_is_uncapped_unless_asked(spark):
    df = spark.createDataFrame([(1, 0, 5000), (1, 1, 1)], "k int, i int, amount long")
    assert column(stateful.capped_total(df, "amount", 1000, "k", "i"), "accepted") == [True, False]
    assert column(stateful.capped_total(df, "amount", 1000, "k", "i", cap_first=True), "accepted") == [False, True]


def test_sessions_join_at_exactly_the_gap(spark):
    rows = [(1, t) for t in (0, 10, 19, 30)]
    df = spark.createDataFrame(rows, "k int, s long").withColumn("ts", F.timestamp_seconds("s"))
    out = timewindows.session_numbers(df, "ts", "10 SECOND", "k", "ts")
    assert column(out, "session_no", "s") == [1, 1, 1, 2]
    built_in = timewindows.sessions(df, "ts", "10 seconds", "k").orderBy("session_start").collect()
    assert [r["n"] for r in built_in] == [3, 1]


def test_bounded_sessions_can_fail(spark):
    df = spark.createDataFrame([(1, t) for t in (0, 1, 2)], "k int, s long").withColumn("ts", F.timestamp_seconds("s"))
    with pytest.raises(ValueError, match="more than 2"):
        timewindows.bounded_sessions(df, "ts", "10 SECOND", "k", "ts", 2, keep="fail")


def test_repeat(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    assert sorted(r["n"] for r in shape.repeat(df, F.col("n")).collect()) == [1, 3, 3, 3]
    assert shape.duplicate(df).count() == 6


def test_errors_stop_or_resume(spark):
    df = spark.createDataFrame([(1, 0), (4, 2)], "a int, b int")
    assert [r["q"] for r in shape.safe_divide(df, "a", "b", "q").collect()] == [2.0]
    with pytest.raises(Exception, match="division by zero"):
        shape.safe_divide(df, "a", "b", "q", on_error="stop").collect()
    words = spark.createDataFrame([("1",), ("x",), (None,)], "w string")
    assert [r["w"] for r in shape.safe_cast(words, "w", "int").orderBy("w").collect()] == [None, 1]


def test_take_and_drop_while(spark, limit):
    df = numbers(spark, [1, 2, 9, 1, 9])
    small = F.col("x") < 5
    assert column(shape.take_while(df, small, [], "i", limit=limit), "x") == [1, 2]
    assert column(shape.drop_while(df, small, [], "i", limit=limit), "x") == [9, 1, 9]


def test_high_water_mark(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([1, 3, 2, 3, 5])], "i int, seq long")
    out = merge.flag_duplicates(df, "seq", "i", {"a": 0, "b": 3})
    assert column(out.where("consumer = 'a'"), "is_duplicate") == [False, False, True, True, False]
    assert column(out.where("consumer = 'b'"), "is_duplicate") == [True, True, True, True, False]


def test_percentiles(spark, limit):
    df = numbers(spark, range(1, 11))
    out = aggs.percentiles(df, "x", [0.1, 0.5, 0.9, 1.0], limit=limit)
    assert column(out, "value", "p") == [1, 5, 9, 10]


def test_lookup_beyond_the_broadcast_bound(spark):
    left = spark.range(100).toDF("k")
    right = spark.range(50).toDF("k").withColumn("v", F.lit(1))
    small, large = joins.lookup(left, right, "k"), joins.lookup(left, right, "k", max_rows=10)
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_asof_same_instant_counts(spark):
    fast = spark.createDataFrame([(1, 5, 10), (1, 7, 11), (2, 5, 12)], "k int, t int, id int")
    slow = spark.createDataFrame([(1, 5, 1, "a"), (1, 8, 2, "b")], "k int, t int, id int, v string")
    out = joins.asof(fast, slow, "t", "id", ["v"], "k").orderBy("id").collect()
    assert [r["slow_v"] for r in out] == ["a", "a", None]


def test_running_set(spark):
    rows = [(0, "add", 1), (1, "add", 2), (2, "add", 1), (3, "remove", 1), (4, "remove", 9)]
    df = spark.createDataFrame(rows, "seq int, cmd string, id int")
    out = timewindows.running_set(df, "id", F.col("cmd") == "add", "seq").orderBy("seq").collect()
    assert [r["set_size"] for r in out] == [1, 2, 2, 1, 1]
    assert [r["changed"] for r in out] == [True, True, False, True, False]
    assert [r["reply"] for r in out] == ["Added", "Added", "Added", "Removed", "Removed"]


def test_consistent_hash_moves_only_the_removed_nodes_keys(spark):
    df = spark.range(2000).toDF("k")
    five, four = ["n0", "n1", "n2", "n3", "n4"], ["n0", "n1", "n2", "n3"]
    both = routing.consistent_hash(routing.consistent_hash(df, "k", five, 50, "was"), "k", four, 50, "now")
    assert both.count() == 2000
    assert both.where("was <> 'n4' AND was <> now").count() == 0
    assert both.where("was = 'n4'").count() > 0

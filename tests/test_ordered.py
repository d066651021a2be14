"""Split groups have to give what unsplit ones give."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import aggs, windows
from millrace.ordered import Ordered

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows; some values are null."""
    return spark.range(600).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.expr("(id * 7919) % 601").alias("t"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("x"),
    )


def result(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


KINDS = {
    "s": ("sum", "x"),
    "c": ("count", "x"),
    "mx": ("max", "x"),
    "mn": ("min", "x"),
    "l": ("last", "x"),
    "f": ("first", "x"),
    "a": ("and", "b"),
    "o": ("or", "b"),
}


@pytest.mark.parametrize("key", [["key"], []])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running(rows, key, exclusive):
    data = rows.withColumn("b", F.col("x") > 3)
    whole = Ordered(data, key, ["t"]).running(KINDS, exclusive)
    parts = Ordered.of(data, key, ["t"], limit=40).running(KINDS, exclusive)
    assert parts.split
    assert result(parts.df) == result(whole.df)


@pytest.mark.parametrize("key", [["key"], []])
@pytest.mark.parametrize("before,after", [(3, 0), (0, 2), (2, 2), (95, 0)])
def test_bounded(rows, key, before, after):
    build = lambda w: {
        "lag": F.lag("x", before).over(w),
        "lead": F.lead("x", after).over(w),
        "sum": F.sum("x").over(w.rowsBetween(-before, after)),
    }
    whole = Ordered(rows, key, ["t"]).bounded(build, before, after)
    parts = Ordered.of(rows, key, ["t"], limit=40).bounded(build, before, after)
    assert parts.split and result(parts.df) == result(whole.df)


def test_total_and_chain(rows):
    whole = Ordered(rows, ["key"], ["t"]).position().total({"n": ("count", F.lit(1)), "m": ("max", "x")})
    parts = Ordered.of(rows, "key", "t", limit=40).position().total({"n": ("count", F.lit(1)), "m": ("max", "x")})
    assert result(parts.df) == result(whole.df)


def gate(state, t):
    (last,) = state
    if last is None or t >= last + 10:
        return (t,), (True,)
    return state, (False,)


def counter(state, t):
    """A state that never forgets: needs the most rounds."""
    n = state[0] + 1
    return (n,), (n,)


@pytest.mark.parametrize("step,init,kind", [(gate, (None,), T.BooleanType()), (counter, (0,), T.LongType())])
def test_fold(rows, step, init, kind):
    whole = Ordered(rows, ["key"], ["t"]).fold(["t"], init, step, [("out", kind)])
    parts = Ordered.of(rows, "key", "t", limit=40)
    assert parts.split
    assert result(parts.fold(["t"], init, step, [("out", kind)])) == result(whole)


@pytest.mark.parametrize("key", [["key"], []])
@pytest.mark.parametrize("n", [63, 64, 65, 130])
def test_moving_average_of_odd_values(rows, key, n):
    """Nulls count as no value, and a NaN only in the frames that hold it, for any n and layout."""
    x = F.when(F.col("t") == 90, float("nan")).when(~F.col("t").between(100, 380), F.col("x") * 0.1)
    data = rows.withColumn("x", x.cast("double"))
    whole = windows.moving_average(data, "x", key, ["t"], n, limit=10_000)
    parts = windows.moving_average(data, "x", key, ["t"], n, limit=40)
    groups = {}
    for r in sorted(data.collect(), key=lambda r: r.t):
        groups.setdefault(r.key if key else None, []).append(r)
    expected = {}
    for group in groups.values():
        for i, r in enumerate(group):
            values = [g.x for g in group[max(0, i - n + 1) : i + 1] if g.x is not None]
            expected[r.t] = 0.0 if i + 1 < n else sum(values) / n if values else None
    for df in (whole, parts):
        got = {r.t: r.moving_avg for r in df.collect()}
        assert got == {t: pytest.approx(v, abs=1e-9, nan_ok=True) for t, v in expected.items()}


def test_whole_lists_and_texts(spark):
    df = spark.range(2500).select((F.col("id") % 2).alias("k"), "id", F.col("id").cast("string").alias("s"))
    got = {r.k: r.text for r in aggs.concat_text(df, "s", "k", "id", limit=300).collect()}
    assert got == {k: "".join(map(str, range(k, 2500, 2))) for k in (0, 1)}
    got = {r.k: r["items"] for r in aggs.ordered_lists(df, "id", "k", "id").collect()}
    assert got == {k: list(range(k, 2500, 2)) for k in (0, 1)}


@pytest.mark.parametrize("n", [1000, 1001])
def test_retain_beyond_the_group_limit(spark, n):
    df = spark.range(2600).select((F.col("id") % 2).alias("k"), "id")
    old = sorted(r.id for r in aggs.retain(df, n, "k", "id").collect())
    new = sorted(r.id for r in aggs.retain(df, n, "k", "id", "newest").collect())
    assert old == list(range(2 * n))
    assert new == list(range(2600 - 2 * n, 2600))

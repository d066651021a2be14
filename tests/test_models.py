"""Stateful rules and ring-buffer windows against short Python models, on skewed random data."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import stateful, windows


def data(seed, n=240):
    rnd = random.Random(seed)
    clock, rows = 0, []
    for i in range(n):
        clock += rnd.choice([0, 1, 2, 5, 30])
        rows.append(("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(4)}", i, clock, rnd.randrange(1, 120)))
    return rows


def modelled(rows, fresh):
    """Run ``fresh()``'s function over each key in order."""
    machines, out = {}, {}
    for key, i, t, x in rows:
        if key not in machines:
            machines[key] = fresh()
        out[i] = machines[key](t, x)
    return out


def gate(d):
    last = [None]

    def run(t, x):
        if last[0] is None or t - last[0] >= d:
            last[0] = t
            return True
        return False

    return run


def limiter(number, period):
    log = []

    def run(t, x):
        if len(log) < number or t - log[-number] >= period:
            log.append(t)
            return True
        return False

    return run


def groups(size, span):
    state = {"no": 0, "n": size, "since": 0}

    def run(t, x):
        if state["n"] >= size or t - state["since"] >= span:
            state.update(no=state["no"] + 1, n=0, since=t)
        state["n"] += 1
        return state["no"]

    return run


def capped(cap):
    total = [None]

    def run(t, x):
        if total[0] is None:
            total[0] = x
        elif total[0] + x < cap:
            total[0] += x
        else:
            return False, total[0]
        return True, total[0]

    return run


def ring(capacity):
    buffer = []

    def run(t, x):
        buffer.append(x)
        return 0.0 if len(buffer) < max(1, capacity - 1) else sum(buffer[-capacity:]) / capacity

    return run


CASES = {
    "gate": (lambda: gate(20), lambda df, lim: stateful.rate_limit(df, "t", 1, 20, "k", "i", limit=lim), "accepted"),
    "limiter": (lambda: limiter(3, 40), lambda df, lim: stateful.rate_limit(df, "t", 3, 40, "k", "i", limit=lim), "accepted"),
    "groups": (lambda: groups(5, 25), lambda df, lim: stateful.grouped_within(df, "t", 5, 25, "k", "i", limit=lim), "group_no"),
    "capped": (
        lambda: capped(1000),
        lambda df, lim: stateful.capped_total(df, "x", 1000, "k", "i", limit=lim).withColumn("r", F.struct("accepted", "total")),
        "r",
    ),
    "ring": (lambda: ring(8), lambda df, lim: windows.moving_average_ring(df, "x", "k", "i", 8, "r", limit=lim), "r"),
    "ring of one": (lambda: ring(1), lambda df, lim: windows.moving_average_ring(df, "x", "k", "i", 1, "r", limit=lim), "r"),
}


@pytest.mark.parametrize("limit", [None, 30])
@pytest.mark.parametrize("case", CASES)
def test_against_model(spark, case, limit):
    model, run, column = CASES[case]
    rows = data(len(case))
    df = spark.createDataFrame(rows, "k string, i long, t long, x long")
    got = {r["i"]: tuple(r[column]) if case == "capped" else r[column] for r in run(df, limit).collect()}
    expected = modelled(rows, model)
    assert got.keys() == expected.keys()
    for i, v in expected.items():
        assert got[i] == (pytest.approx(v) if isinstance(v, float) else v), i

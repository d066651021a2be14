import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger, rules

OPS = (
    "seq long, op string, no string, to_no string, type string, rate decimal(5,2), amount long, "
    "op_date date, open_date date, close_date date"
)
DAY = dt.date(2020, 5, 1)


def op(seq, kind, no, to=None, amount=0, type="checking", rate=None, day=DAY, opened=None, closed=None):
    rate = None if rate is None else Decimal(rate)
    return (seq, kind, no, to, type, rate, amount, day, opened, closed)


def run(spark, *ops, limit=None):
    return ledger.run(spark.createDataFrame(list(ops), OPS), limit=limit)


def outcome(results):
    return [(r["seq"], r["ok"], r["errors"], r["balance"]) for r in results.orderBy("seq", "leg").collect()]


@pytest.mark.parametrize("limit", [None, 2])
def test_two_accounts_and_a_transfer(spark, limit):
    a, b = "3445684569463567", "3463568456374573"
    results = run(
        spark, op(1, "open", a), op(2, "open", b), op(3, "credit", a, amount=5500), op(4, "credit", b, amount=6000),
        op(5, "transfer", a, b, amount=1000), limit=limit,
    )
    assert {r["no"]: r["balance"] for r in ledger.balances(results).collect()} == {a: 4500, b: 7000}


def test_rejections(spark):
    results = run(
        spark,
        op(1, "credit", "AAAAA", amount=1),
        op(2, "open", "AAAAA"),
        op(3, "open", "AAAAA"),
        op(4, "debit", "AAAAA", amount=1),
        op(5, "close", "AAAAA", closed=dt.date(2019, 1, 1)),
        op(6, "close", "AAAAA"),
        op(7, "debit", "AAAAA", amount=1),
    )
    assert outcome(results) == [
        (1, False, ["Account AAAAA does not exist"], None),
        (2, True, [], 0),
        (3, False, ["Already existing account with no AAAAA"], 0),
        (4, False, ["Insufficient amount in AAAAA to debit"], 0),
        (5, False, ["Close date [2019-01-01] cannot be earlier than open date [2020-05-01]"], 0),
        (6, True, [], 0),
        (7, False, ["Account AAAAA is already closed", "Insufficient amount in AAAAA to debit"], 0),
    ]


def test_half_done_transfer(spark):
    results = run(spark, op(1, "open", "AAAAA"), op(2, "open", "BBBBB"), op(3, "transfer", "AAAAA", "BBBBB", amount=5))
    assert [tuple(r) for r in ledger.half_done_transfers(results).collect()] == [(3, False, True)]


def test_opening_checks(spark):
    ops = [
        op(1, "open", "A1", closed=dt.date(2000, 1, 1)),
        op(2, "open", "AAAAA", type="savings"),
        op(3, "open", "AAAAA", type="savings", rate=0),
        op(4, "open", "AAAAA", type="savings", rate=1),
        op(5, "open", "AAAAA"),
    ]
    got = ledger.check_openings(spark.createDataFrame(ops, OPS)).orderBy("seq").collect()
    assert [r["errors"] for r in got] == [
        [
            "Account No has to be at least 5 characters long: found A1",
            "Close date [2000-01-01] cannot be earlier than open date [2020-05-01]",
        ],
        ["Rate needs to be given for savings account"],
        ["Interest rate 0.00 must be > 0"],
        [],
        ["Already existing account with no AAAAA"],
    ]


def test_reports(spark):
    results = run(
        spark, op(1, "open", "AAAAA", type="savings", rate=2), op(2, "open", "BBBBB", opened=dt.date(2020, 1, 1)),
        op(3, "credit", "AAAAA", amount=10),
    )
    table = ledger.accounts(results)
    assert [r["no"] for r in ledger.opened_on(table, "2020-01-01").collect()] == ["BBBBB"]
    assert {r["no"]: r["rate"] and float(r["rate"]) for r in ledger.rates(table).collect()} == {"AAAAA": 2.0, "BBBBB": None}
    wanted = spark.createDataFrame([("AAAAA",), ("ZZZZZ",)], "no string")
    got = {r["no"]: (r["balance"], r["error"]) for r in ledger.balance_of(wanted, ledger.balances(results)).collect()}
    assert got == {"AAAAA": (10, None), "ZZZZZ": (None, "No account exists with no ZZZZZ")}


# A hot account: long runs of credits and debits, some of them refused.
@pytest.mark.parametrize("limit", [7, 40])
def test_hot_account(spark, limit):
    ops = [op(0, "open", "AAAAA")]
    for i in range(1, 200):
        kind = "debit" if (i * 7) % 5 < 3 and i > 20 else "credit"
        ops.append(op(i, kind, "AAAAA", amount=(i * 37) % 101))
    ops.append(op(200, "close", "AAAAA"))
    ops.append(op(201, "credit", "AAAAA", amount=1))
    assert outcome(run(spark, *ops, limit=limit)) == outcome(run(spark, *ops))


# -- rules ----------------------------------------------------------------------


def checked(spark, rule, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    r = rules.validate(df, rule).first()
    return r["valid"], r["valid_values"], r["errors"]


def test_unique_product(spark):
    assert checked(spark, rules.unique_product("p", {"a", "b", "c"}), p="a1") == (True, ["a1"], [])
    taken = rules.unique_product("p", {"a", "b", "c", "a1"})
    assert checked(spark, taken, p="a1") == (False, [], ["uniqueProductName failed"])


def test_or_then_and(spark):
    rule = (rules.unique_product("p", {"b", "c"}) | rules.known_spec_map("s", {21: "a", 3: "b"})) & rules.unique_spec("n", {2, 3, 4, 6})
    assert checked(spark, rule, p="b", s=21, n=1) == (True, ["21", "1"], [])
    assert checked(spark, rule, p="b", s=7, n=2) == (
        False, [], ["uniqueProductName failed", "knownSpecMap failed", "uniqueSpec failed"],
    )


def test_missing_optional_passes(spark):
    df = spark.createDataFrame([(None,), (5,), (1,)], "s int")
    got = rules.validate(df, rules.known_spec_optional("s", {1: "x"})).orderBy("s").collect()
    assert [r["valid"] for r in got] == [True, True, False]
    assert got[2]["errors"] == ["knownSpecOptMap failed"]


def test_empty_set(spark):
    assert checked(spark, rules.known_product("p", set()), p="a")[0] is False
    assert checked(spark, rules.unique_spec("p", set()), p="a")[0] is True


def test_flagged_rule(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "p string, known boolean")
    got = rules.validate(df, rules.flagged("p", "known", "knownProductName")).orderBy("p")
    assert [r["errors"] for r in got.collect()] == [[], ["knownProductName failed"]]
    assert got.where(F.col("valid")).count() == 1

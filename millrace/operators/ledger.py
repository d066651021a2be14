"""Account ledger: openings, credits, debits, transfers and closings, in order.

Operations are rows ``(seq, op, no, to_no, type, rate, amount, op_date, open_date, close_date)``:

* ``op``: open, credit, debit, transfer, close; ``no`` the account, ``to_no`` the other
  account of a transfer
* ``type``: checking or savings; ``amount`` in the smallest unit (cents) as a long
* ``op_date``: the day of the operation, standing in where no other date is given

A transfer is a debit of one account and a credit of the other, each judged on its own,
so that accounts are independent and run in parallel.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.ordered import Jump, Ordered

# Error texts are fixed values.
MIN_NO_LENGTH = 5
NO_TOO_SHORT = "Account No has to be at least 5 characters long: found "
RATE_MISSING = "Rate needs to be given for savings account"


def _errors(*checks: tuple[Column, Column]) -> Column:
    """Texts of the checks that failed, in order."""
    texts = F.array(*[F.when(F.coalesce(failed, F.lit(False)), text) for failed, text in checks])
    return F.array_compact(texts)


def opening_errors() -> Column:
    """Checks of an opening by itself (not: whether the number is taken)."""
    opened = F.coalesce(F.col("open_date"), F.col("op_date"))
    dates = F.format_string(
        "Close date [%s] cannot be earlier than open date [%s]", F.col("close_date").cast("string"), opened.cast("string")
    )
    savings = F.col("type") == "savings"
    return F.when(savings & F.col("rate").isNull(), F.array(F.lit(RATE_MISSING))).otherwise(
        _errors(
            (F.length("no") < MIN_NO_LENGTH, F.concat(F.lit(NO_TOO_SHORT), "no")),
            (F.col("close_date") < opened, dates),
            (
                savings & (F.col("rate") <= 0),
                F.format_string("Interest rate %s must be > 0", F.col("rate").cast("string")),
            ),
        )
    )


def check_openings(openings: DataFrame, limit: int | None = None) -> DataFrame:
    """Openings with their ``errors``; a number is taken once an earlier opening of it
    succeeded."""
    checked = openings.withColumn("errors", opening_errors())
    valid = F.when(F.size("errors") == 0, F.lit(1))
    o = Ordered.of(checked, "no", "seq", limit).running({"_taken": ("count", valid)}, exclusive=True)
    exists = F.array(F.concat(F.lit("Already existing account with no "), "no"))
    return o.df.withColumn("errors", F.when(F.col("_taken") > 0, exists).otherwise(F.col("errors"))).drop("_taken")


def legs(ops: DataFrame) -> DataFrame:
    """One row per operation and account; ``leg`` orders the two of a transfer."""

    def leg(no: str, action: Column, order: int) -> Column:
        return F.struct(F.col(no).alias("account"), action.alias("action"), F.lit(order).alias("leg"))

    single = F.array(leg("no", F.col("op"), 0))
    both = F.array(leg("no", F.lit("debit"), 0), leg("to_no", F.lit("credit"), 1))
    rows = ops.withColumn("_leg", F.explode(F.when(F.col("op") == "transfer", both).otherwise(single)))
    return rows.select("*", "_leg.account", "_leg.action", "_leg.leg").drop("_leg")


def _ledger_step(state, no, action, amount, opening, opened, day, closing):
    """State: exists, closed, open day, balance. Days are counted from 1970."""
    exists, closed, since, balance = state
    if action == "open":
        if exists:
            return state, (False, [f"Already existing account with no {no}"], balance)
        if opening:
            return state, (False, list(opening), None)
        return (True, closing is not None, opened, 0), (True, [], 0)
    if not exists:
        return state, (False, [f"Account {no} does not exist"], None)
    errors = [f"Account {no} is already closed"] if closed else []
    if action == "close":
        day = day if closing is None else closing
        if since is not None and day < since:
            errors.append(f"Close date [{_iso(day)}] cannot be earlier than open date [{_iso(since)}]")
        return (state, (False, errors, balance)) if errors else ((True, True, since, balance), (True, [], balance))
    change = -amount if action == "debit" else amount
    if change < 0 and balance < -change:
        errors.append(f"Insufficient amount in {no} to debit")
    if errors:
        return state, (False, errors, balance)
    return (exists, closed, since, balance + change), (True, [], balance + change)


def _add_leg(summary, no, action, amount, *_):
    """Net change, lowest point on the way, and whether a closing is among the legs."""
    total, low, closing = summary
    if action == "credit":
        total += amount
    elif action == "debit":
        total -= amount
    return total, min(low, total), closing or action == "close"


def _pass_legs(state, summary):
    """An open account that never runs short takes every leg; a closed one takes none."""
    exists, closed, since, balance = state
    total, low, closing = summary
    if exists and closed:
        return state
    if exists and not closing and balance + low >= 0:
        return exists, closed, since, balance + total
    return None


def _iso(day: int) -> str:
    return (date(1970, 1, 1) + timedelta(days=day)).isoformat()


def run(ops: DataFrame, limit: int | None = None) -> DataFrame:
    """Every leg with ``ok``, ``errors`` and the account's ``balance`` after it."""
    prepared = legs(ops).withColumns(
        {
            "_opening": F.when(F.col("action") == "open", opening_errors()),
            "_opened": F.unix_date(F.coalesce("open_date", "op_date")),
            "_day": F.unix_date("op_date"),
            "_closing": F.unix_date("close_date"),
        }
    )
    outputs = [("ok", T.BooleanType()), ("errors", T.ArrayType(T.StringType())), ("balance", T.LongType())]
    inputs = ["account", "action", "amount", "_opening", "_opened", "_day", "_closing"]
    done = Ordered.of(prepared, "account", ["seq", "leg"], limit).fold(
        inputs, (False, False, None, 0), _ledger_step, outputs, Jump((0, 0, False), _add_leg, _pass_legs)
    )
    return done.drop("_opening", "_opened", "_day", "_closing")


def balances(results: DataFrame) -> DataFrame:
    """Report ``(no, balance)`` of all accounts."""
    last = results.where("balance IS NOT NULL").groupBy(F.col("account").alias("no"))
    return last.agg(F.max_by("balance", F.struct("seq", "leg")).alias("balance"))


def half_done_transfers(results: DataFrame) -> DataFrame:
    """Transfers of which only one leg went through."""
    return (
        results.where("op = 'transfer'")
        .groupBy("seq")
        .agg(F.bool_or(F.col("ok") & (F.col("leg") == 0)).alias("debited"), F.bool_or(F.col("ok") & (F.col("leg") == 1)).alias("credited"))
        .where("debited <> credited")
    )


def accounts(results: DataFrame) -> DataFrame:
    """Accounts that exist, with their opening and closing dates and balance: one pass."""
    opened = F.when(
        (F.col("action") == "open") & F.col("ok"),
        F.struct("type", "rate", F.coalesce("open_date", "op_date").alias("date_of_open"), "close_date"),
    )
    closed = F.when((F.col("action") == "close") & F.col("ok"), F.coalesce("close_date", "op_date"))
    known = F.when(F.col("balance").isNotNull(), F.struct("seq", "leg"))
    return (
        results.groupBy(F.col("account").alias("no"))
        .agg(F.max(opened).alias("_o"), F.max(closed).alias("_closed"), F.max_by("balance", known).alias("balance"))
        .where("_o IS NOT NULL")
        .select(
            "no", "_o.type", "_o.rate", "_o.date_of_open", F.coalesce("_o.close_date", "_closed").alias("date_of_close"), "balance"
        )
    )


def balance_of(wanted: DataFrame, balance_report: DataFrame) -> DataFrame:
    """Balance of each wanted ``no``, or an error."""
    found = wanted.join(balance_report, "no", "left")
    missing = F.when(F.col("balance").isNull(), F.concat(F.lit("No account exists with no "), "no"))
    return found.withColumn("error", missing)


def opened_on(account_table: DataFrame, day: str) -> DataFrame:
    return account_table.where(F.col("date_of_open") == F.lit(day).cast("date"))


def rates(account_table: DataFrame) -> DataFrame:
    """Interest rate of savings accounts, null for others."""
    return account_table.select("no", F.when(F.col("type") == "savings", F.col("rate")).alias("rate"))

"""Rules that depend on their own earlier decisions, so that no window expresses them.

The step functions are shared with the streaming processors in ``millrace.streaming``.
Times are numbers (say, microseconds); see ``Ordered.fold`` for how hot keys are split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.ordered import Jump, Ordered
from millrace.session import store

Names = str | Sequence[str]


def gate_step(silence: int) -> Callable:
    """State: time of the last row let through."""

    def step(state, at):
        if state[0] is None or at - state[0] >= silence:
            return (at,), (True,)
        return state, (False,)

    return step


def rate_limit_step(number: int, period: int) -> Callable:
    """State: the times of the last ``number`` accepted rows, oldest first."""

    def step(state, at):
        accepted = list(state)
        if len(accepted) < number or at - accepted[0] >= period:
            return tuple((accepted + [at])[-number:]), (True,)
        return state, (False,)

    return step


def grouped_within_step(size: int, span: int) -> Callable:
    """State: rows in the open group and its first time. Emits whether a group starts."""

    def step(state, at):
        count, since = state
        if count == 0 or count >= size or at - since >= span:
            return (1, at), (True,)
        return (count + 1, since), (False,)

    return step


def capped_total_step(cap: int, cap_first: bool) -> Callable:
    """State: running total, null before the first row. A row is accepted while the
    total stays below ``cap``; the first one is only checked with ``cap_first``."""

    def step(state, amount):
        total = state[0]
        if total is None and not cap_first:
            return (amount,), (True, amount)
        if amount + (total or 0) < cap:
            return (amount + (total or 0),), (True, amount + (total or 0))
        return state, (False, total)

    return step


def capped_total_jump(cap: int) -> Jump:
    """A segment of which every row, or none, is accepted."""

    def add(summary, amount):
        total, least = summary
        return total + amount, amount if least is None else min(least, amount)

    def apply(state, summary):
        total, least = summary
        if state[0] is None or least < 0:
            return None
        if state[0] + total < cap:
            return (state[0] + total,)
        return tuple(state) if state[0] + least >= cap else None

    return Jump((0, None), add, apply)


def timed_gate(df: DataFrame, at: str, silence: int, key: Names, order_by: Names, limit: int | None = None) -> DataFrame:
    """Lets a row through, then none until ``silence`` has passed."""
    folded = Ordered.of(df, key, order_by, limit).fold([at], (None,), gate_step(silence), [("_open", T.BooleanType())])
    return folded.where("_open").drop("_open")


def rate_limit(
    df: DataFrame, at: str, number: int, period: int, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Adds ``accepted``: at most ``number`` accepted rows in any ``period``."""
    step = rate_limit_step(number, period)
    return Ordered.of(df, key, order_by, limit).fold([at], (), step, [("accepted", T.BooleanType())])


def grouped_within(
    df: DataFrame, at: str, size: int, span: int, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Adds ``group_no``: a group is full at ``size`` rows or closes ``span`` after its
    first row, whichever comes first. The fold only marks where groups start, so its
    state forgets the past; numbering is a running count."""
    step = grouped_within_step(size, span)
    marked = Ordered.of(df, key, order_by, limit).fold([at], (0, None), step, [("_starts", T.BooleanType())])
    # Stored, so that the numbering does not run the fold again.
    numbered = Ordered.of(store(marked, "marked"), key, order_by, limit).running({"group_no": ("sum", F.col("_starts").cast("long"))})
    return numbered.df.drop("_starts")


def capped_total(
    df: DataFrame,
    amount: str,
    cap: int,
    key: Names,
    order_by: Names,
    cap_first: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Adds ``accepted`` and ``total``, the accepted total so far."""
    outputs = [("accepted", T.BooleanType()), ("total", T.LongType())]
    step = capped_total_step(cap, cap_first)
    return Ordered.of(df, key, order_by, limit).fold([amount], (None,), step, outputs, capped_total_jump(cap))


def fold_rows(
    df: DataFrame,
    inputs: Sequence[str],
    init: tuple,
    step: Callable,
    outputs: Sequence[tuple[str, T.DataType]],
    key: Names,
    order_by: Names,
    jump: Jump | None = None,
    limit: int | None = None,
) -> DataFrame:
    """A user's own stateful operator: rows of a key in sequence, keys in parallel. A hot
    key whose state never forgets is walked one segment after the other, unless ``jump``
    can tell what a segment does to a state."""
    return Ordered.of(df, key, order_by, limit).fold(inputs, init, step, outputs, jump)

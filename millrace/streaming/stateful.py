"""Stateful stream operators: the rules of ``millrace.operators.stateful`` per key, with
state kept between micro-batches.

Rows of a key are put in order within a micro-batch; rows that come in a later
micro-batch than their successors are judged when they come.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators import stateful as rules
from millrace.streaming.runs import use_rocksdb

Names = str | Sequence[str]


class StepProcessor(StatefulProcessor):
    """Runs ``step(state, *inputs) -> (state, outputs)``; the state is one JSON value of
    bounded size per key, read and written once per micro-batch."""

    def __init__(self, order_by, inputs, init, step, names, keep):
        self.order_by, self.inputs, self.first, self.step = order_by, inputs, init, step
        self.names, self.keep = names, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", T.StructType([T.StructField("json", T.StringType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = sorted(rows, key=lambda r: [r[c] for c in self.order_by])
        held = self.state.get()
        current = self.first if held is None else tuple(json.loads(held[0]))
        make = Row(*self.names)
        for row in batch:
            current, emitted = self.step(current, *[row[c] for c in self.inputs])
            if self.keep is None:
                yield make(*row, *emitted)
            elif emitted[self.keep]:
                yield make(*row, *emitted[: self.keep], *emitted[self.keep + 1 :])
        self.state.update((json.dumps(current),))

    def close(self) -> None:
        pass


def fold_stream(
    stream: DataFrame,
    key: Names,
    order_by: Sequence[str],
    inputs: Sequence[str],
    init: tuple,
    step: Callable,
    outputs: Sequence[tuple[str, T.DataType]],
    keep: str | None = None,
) -> DataFrame:
    """A stateful operator on a stream. ``keep`` names a boolean output: only rows where it
    is true are emitted, without it. A micro-batch of one key is held by one task: bound it
    at the source (``maxFilesPerTrigger``)."""
    use_rocksdb(stream.sparkSession)
    keys = [key] if isinstance(key, str) else list(key)
    shown = [(n, t) for n, t in outputs if n != keep]
    schema = T.StructType(list(stream.schema.fields) + [T.StructField(n, t) for n, t in shown])
    kept = None if keep is None else [n for n, _ in outputs].index(keep)
    processor = StepProcessor(list(order_by), list(inputs), init, step, schema.names, kept)
    return stream.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None"
    )


def timed_gate(stream: DataFrame, at: str, silence: int, key: Names, order_by: Sequence[str]) -> DataFrame:
    """Lets a row through, then none until ``silence`` has passed."""
    outputs = [("_open", T.BooleanType())]
    return fold_stream(stream, key, order_by, [at], (None,), rules.gate_step(silence), outputs, keep="_open")


def rate_limit(stream: DataFrame, at: str, number: int, period: int, key: Names, order_by: Sequence[str]) -> DataFrame:
    """Adds ``accepted``: at most ``number`` accepted rows in any ``period``."""
    outputs = [("accepted", T.BooleanType())]
    return fold_stream(stream, key, order_by, [at], (), rules.rate_limit_step(number, period), outputs)


def grouped_within(stream: DataFrame, at: str, size: int, span: int, key: Names, order_by: Sequence[str]) -> DataFrame:
    """Adds ``group_no``; here the state holds the number, as it lives on anyway."""
    starts = rules.grouped_within_step(size, span)

    def step(state, t):
        inner, (new,) = starts(tuple(state[:2]), t)
        number = state[2] + int(new)
        return (*inner, number), (number,)

    return fold_stream(stream, key, order_by, [at], (0, None, 0), step, [("group_no", T.LongType())])


def capped_total(stream: DataFrame, amount: str, cap: int, key: Names, order_by: Sequence[str], cap_first: bool = False) -> DataFrame:
    """Adds ``accepted`` and ``total``."""
    outputs = [("accepted", T.BooleanType()), ("total", T.LongType())]
    return fold_stream(stream, key, order_by, [amount], (None,), rules.capped_total_step(cap, cap_first), outputs)


def set_changes(stream: DataFrame, is_add: str, key: Names, order_by: Sequence[str]) -> DataFrame:
    """Adds ``changed`` for add and remove commands of members (the key): did the command
    alter the set? ``is_add`` is a boolean column."""

    def step(state, add):
        return (bool(add),), (bool(add) != state[0],)

    return fold_stream(stream, key, order_by, [is_add], (False,), step, [("changed", T.BooleanType())])


def last_seen(stream: DataFrame, key: Names, order_by: Sequence[str], value: str, kind: T.DataType) -> DataFrame:
    """After each row, the value seen before it by this key (null for the first)."""

    def step(state, v):
        return (v,), (state[0],)

    return fold_stream(stream, key, order_by, [value], (None,), step, [("previous", kind)])


def unchanged_runs(
    stream: DataFrame, prop: str, key: Names, order_by: Sequence[str], at: str, inactivity: int | None = None
) -> DataFrame:
    """Adds ``run_no``: a new run begins when the property changes or, with ``inactivity``,
    after a longer pause. ``at`` is the time as a number."""

    def step(state, value, now):
        number, was, last = state
        paused = inactivity is not None and last is not None and now - last > inactivity
        if number == 0 or value != was or paused:
            number += 1
        return (number, value, now), (number,)

    return fold_stream(stream, key, order_by, [prop, at], (0, None, None), step, [("run_no", T.LongType())])


def flag_duplicates(stream: DataFrame, seq: str, key: Names, order_by: Sequence[str], start: int) -> DataFrame:
    """Adds ``is_duplicate``: at or below the highest sequence number that this key has
    seen, which begins at ``start``."""

    def step(state, number):
        return (max(state[0], number),), (number <= state[0],)

    return fold_stream(stream, key, order_by, [seq], (start,), step, [("is_duplicate", T.BooleanType())])

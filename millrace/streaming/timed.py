"""Stream operators in event time: rows wait until the watermark has passed them and are then
judged in order; groups close by timers.

A row is kept in the state of its key's bucket, and a timer of the earliest one's millisecond hands
those to the rule that no earlier row can precede any more: so a row that arrives in a later
micro-batch than its successors gets the same answer as in a table, as long as it is not later
than the delay of the watermark (Spark drops it beyond). Rules that gather groups name a deadline,
after which the group is closed by a timer although no further row of the key has come.

Rows without a time cannot wait; they are judged as they come, before those that do. What is
still waiting or open when the input ends is in the checkpoint, and ``Timed.rest`` reads it there
and judges it as if nothing more came. State per key: the rows of one watermark delay, the rule's
state, and the rows of one open group (bounded by ``max_size``).
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice
from json.encoder import encode_basestring_ascii
from operator import itemgetter
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle

from millrace.operators import stateful as rules
from millrace.session import hadoop_path
from millrace.streaming.runs import BUCKETS_CONF, use_rocksdb

if TYPE_CHECKING:
    import pandas as pd
    import pyarrow as pa

Names = str | Sequence[str]

# Event time in microseconds, the last column of the rows that processors see.
AT = "_at"
# Keys share the state of a bucket, which is read and written whole; a stream keeps their number.
BUCKET, BUCKETS = "_bucket", 2048
# Rows in one piece of the state, which goes there in one message.
MOST_ROWS = 10_000
# A row as bytes: cells reach a processor one by one, and a number or a time costs more there than all the rest.
PACKED = "packed_row"
# What pandas can hold; processors see no event time beyond.
FIRST_TIME, LAST_TIME = "1678-01-01 00:00:00", "2262-01-01 00:00:00"


def _text(value: object) -> str:
    """A value as JSON; most are texts, which need no encoder."""
    return encode_basestring_ascii(value) if type(value) is str else json.dumps(value, default=str)


class StepRule:
    """``step(state, *inputs) -> (state, outputs)`` on each row, which goes on with the outputs
    at once. ``keep`` names a boolean output: only rows where it is true go on, without it."""

    queued = False

    def __init__(self, inputs: Sequence[str], init: tuple, step: Callable, outputs: Sequence[tuple[str, T.DataType]], keep: str | None = None):
        self.inputs, self.init, self.step, self.outputs = list(inputs), init, step, list(outputs)
        self.reads = set(inputs)
        self.kept = None if keep is None else [n for n, _ in outputs].index(keep)

    def bind(self, schema: T.StructType, key: list[str]) -> T.StructType:
        self.places = [schema.fieldNames().index(c) for c in self.inputs]
        shown = [o for i, o in enumerate(self.outputs) if i != self.kept]
        return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in shown]])

    def row(self, state: list | None, queue: list, row: tuple, at: int | None) -> tuple[list, list[tuple]]:
        state, out = self.step(self.init if state is None else tuple(state), *[row[p] for p in self.places])
        if self.kept is None:
            return state, [(*row, *out)]
        return state, [(*row, *out[: self.kept], *out[self.kept + 1 :])] if out[self.kept] else []

    def deadline(self, state: list | None) -> int | None:
        return None

    def close(self, state: list | None, queue: list) -> tuple[list | None, list[tuple]]:
        return state, []


class GroupRule:
    """Numbered groups of rows. ``starts(group, at, value)`` tells whether a row begins a new
    group, ``ends(group)`` until when (in microseconds, that one included) a row may still belong
    to the open one; a group is a dict of number, first, last, n and value (of ``prop``).

    Groups are emitted when they close: their rows with ``out`` and the group's size, at most
    ``max_size`` of them (``keep`` the oldest, the newest, or ``fail``), or, with ``summary``, one
    row of key, number, first and last time, size and the first row's ``carry`` columns."""

    def __init__(self, starts, ends, out: str, prop: str | None = None, max_size: int | None = None, keep: str = "oldest", summary: Sequence[str] | None = None):
        if keep not in ("oldest", "newest", "fail"):
            raise ValueError(f"keep is oldest, newest or fail, not {keep}")
        self.starts, self.ends, self.out, self.prop = starts, ends, out, prop
        self.max_size, self.keep, self.summary = max_size, keep, None if summary is None else list(summary)
        self.queued, self.reads = True, {prop}

    def bind(self, schema: T.StructType, key: list[str]) -> T.StructType:
        names = schema.fieldNames()
        self.place = None if self.prop is None else names.index(self.prop)
        number, size = T.StructField(self.out, T.LongType()), T.StructField("group_size", T.LongType())
        if self.summary is None:
            return T.StructType([*schema.fields, number, size])
        self.carried = [names.index(c) for c in [*key, *self.summary]]
        times = [T.StructField("first_at", T.LongType()), T.StructField("last_at", T.LongType())]
        return T.StructType([*[schema.fields[p] for p in self.carried], number, *times, size])

    def row(self, group: dict | None, queue: list, row: tuple, at: int | None) -> tuple[dict, list[tuple]]:
        value = None if self.place is None else _text(row[self.place])
        emitted: list[tuple] = []
        if group is None or not group["n"] or self.starts(group, at, value):
            number = 0 if group is None else group["number"]
            if group is not None and group["n"]:
                _, emitted = self.close(group, queue)
            group = {"number": number + 1, "first": at, "last": at, "n": 0, "value": value}
        else:
            group = dict(group)
        group["last"], group["n"] = at, group["n"] + 1
        most = 1 if self.summary is not None else self.max_size
        if most is None or len(queue) < most:
            queue.append(row)
        elif self.summary is None and self.keep == "fail":
            raise ValueError(f"more than {most} rows in a group")
        elif self.summary is None and self.keep == "newest":
            del queue[0]
            queue.append(row)
        return group, emitted

    def deadline(self, group: dict | None) -> int | None:
        return self.ends(group) if group is not None and group["n"] else None

    def close(self, group: dict | None, queue: list) -> tuple[dict | None, list[tuple]]:
        if group is None or not group["n"]:
            return group, []
        if self.summary is None:
            out = [(*row, group["number"], group["n"]) for row in queue]
        else:
            out = [(*[queue[0][p] for p in self.carried], group["number"], group["first"], group["last"], group["n"])]
        queue.clear()
        return {**group, "n": 0}, out


# What lists in the state hold and processors put out: many rows in one piece.
PIECE = T.StructType([T.StructField("rows", T.BinaryType())])


def _pieces(rows: Iterable[tuple]) -> Iterator[tuple[bytes]]:
    rows = iter(rows)
    while part := list(islice(rows, MOST_ROWS)):
        yield (pickle.dumps(part),)


def _unpacked(pieces: Iterable[tuple[bytes]]) -> Iterator[tuple]:
    for (piece,) in pieces:
        yield from pickle.loads(piece)


def _replace(held: ListState, rows: Iterable[tuple]) -> None:
    pieces = _pieces(rows)
    if (first := next(pieces, None)) is None:
        held.clear()
        return
    held.put([first])
    for piece in pieces:
        held.appendList([piece])


def _name_of(places: list[int]) -> Callable:
    """A row's key as one text: NaN is equal to itself, and 0.0 to -0.0."""
    return lambda row: json.dumps([v + 0.0 if isinstance(v, float) else v for v in (row[p] for p in places)], default=str)


def _sort_key(places: list[int]) -> Callable:
    """Nulls first, as in a table."""
    return lambda row: [(row[p] is not None, row[p]) for p in places]


def _sorter(places: list[int]) -> Callable:
    """Sorts rows by ``places``; only rows with nulls beside values take the longer way."""
    plain, nulls_first = itemgetter(*places), _sort_key(places)

    def ordered(rows: list[tuple]) -> list[tuple]:
        try:
            return sorted(rows, key=plain)
        except TypeError:
            return sorted(rows, key=nulls_first)

    return ordered


class Judge:
    """A rule on the rows of many keys; ``held`` has the state and the queue of each."""

    def __init__(self, rule, keys: list[int], order: list[int]):
        self.rule, self.name, self.ordered = rule, _name_of(keys), _sorter(order)
        self.keys = keys

    def _by_key(self, rows: Iterable[tuple]) -> dict[str, list[tuple]]:
        """Rows by the name of their key, which is made once for each key that can be looked up."""
        names: dict[tuple, str] = {}
        found: dict[str, list[tuple]] = {}
        for row in rows:
            cells = tuple([row[p] for p in self.keys])
            try:
                name = names.get(cells)
                if name is None:
                    name = names[cells] = self.name(row)
            except TypeError:  # a list or a struct
                name = self.name(row)
            found.setdefault(name, []).append(row)
        return found

    def judge(self, held: dict[str, tuple], rows: Iterable[tuple], passed: int | None) -> Iterator[tuple]:
        """What ``rows`` and groups that are over at ``passed`` put out."""
        rule = self.rule
        for name, new in self._by_key(rows).items():
            state, queue = held.get(name, (None, []))
            for row in self.ordered(new):
                state, emitted = rule.row(state, queue, row[:-1], row[-1])
                yield from emitted
            held[name] = state, queue
        if passed is not None:
            for name, (state, queue) in held.items():
                ends = rule.deadline(state)
                if ends is not None and ends // 1000 < passed:
                    state, emitted = rule.close(state, queue)
                    held[name] = state, queue
                    yield from emitted


class TimedProcessor(StatefulProcessor):
    """Spark's key is a bucket of keys, and a micro-batch costs a bucket a fixed number of calls to
    the state, however many rows and keys it has: all rows that wait are one list, the states of
    all keys another, and one timer stands for the earliest of the rows and of the deadlines."""

    def __init__(self, judge: Judge, at: int | None):
        self.judge, self.at = judge, at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("ms", T.LongType())]))
        self.waiting = handle.getListState("waiting", PIECE)
        self.held = handle.getListState("held", PIECE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def placed() -> Iterator[tuple]:
            for row in rows:
                row = tuple(row)[:-1]
                yield row if self.at is None else (*row[: self.at], row[-1], *row[self.at + 1 :])

        return self._out(self._take(placed()))

    def _out(self, pieces: list[tuple[bytes]]) -> Iterator[Row]:
        return map(Row(*PIECE.names), *zip(*pieces)) if pieces else iter(())

    def _take(self, rows: Iterable[tuple]) -> list[tuple[bytes]]:
        """Keeps rows until they can be judged; what those without a time put out."""
        first, untimed = None, []

        def timed() -> Iterator[tuple]:
            nonlocal first
            for row in rows:
                if row[-1] is None:
                    untimed.append(row)
                else:
                    first = row[-1] if first is None else min(first, row[-1])
                    yield row

        for piece in _pieces(timed()):
            self.waiting.appendList([piece])
        out, times = [], [] if first is None else [first]
        if untimed:
            held = dict(_unpacked(self.held.get()))
            out = list(_pieces(self.judge.judge(held, untimed, None)))
            times += self._hold(held)
        self._register(times, self.timer.get())
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Judges all that the watermark has passed, so that rows, and a group that they open and
        that is over too, go on together."""
        passed = timerValues.getCurrentWatermarkInMs()
        timer = self.timer.get()
        if timer is None or timer[0] != expiredTimerInfo.getExpiryTimeInMs():
            # An earlier one has taken its place.
            return iter(())
        ready, left = [], []
        for row in _unpacked(self.waiting.get()):
            (ready if row[-1] // 1000 < passed else left).append(row)
        if ready:
            _replace(self.waiting, left)
        held = dict(_unpacked(self.held.get()))
        out = list(_pieces(self.judge.judge(held, ready, passed)))
        times = [r[-1] for r in left] + self._hold(held)
        if not times:
            self.timer.clear()
        self._register(times, None)
        return self._out(out)

    def _hold(self, held: dict[str, tuple]) -> list[int]:
        """Keeps the states; the times after which open groups are over."""
        _replace(self.held, held.items())
        return [ends for state, _ in held.values() if (ends := self.judge.rule.deadline(state)) is not None]

    def _register(self, times: list[int], timer: tuple | None) -> None:
        """The timer of the earliest of ``times``, in microseconds, unless one comes before it."""
        due = min(times) // 1000 + 1 if times else None
        if due is not None and (timer is None or due < timer[0]):
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def close(self) -> None:
        pass


class PackedProcessor(TimedProcessor):
    """The same on rows that ``Timed.packed`` has made, which come and go in frames."""

    def handleInputRows(self, key, frames, timerValues) -> Iterator[pd.DataFrame]:
        return self._out(self._take(pickle.loads(row) for frame in frames for row in frame[PACKED]))

    def _out(self, pieces: list[tuple[bytes]]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        return iter([pd.DataFrame(pieces, columns=PIECE.names)] if pieces else [])


def _cells(column: pa.Array) -> list:
    """As ``to_pylist``, which makes numbers one by one."""
    import pyarrow as pa

    plain = not column.null_count and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type))
    return column.to_numpy().tolist() if plain else column.to_pylist()


def _packer(columns: list[str]) -> Column:
    """Each row's cells as bytes."""

    def pack(cells: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import pyarrow as pa

        for batch in cells:
            yield pa.array([pickle.dumps(row) for row in zip(*map(_cells, batch))], pa.binary())

    # Hints that are not texts, which this function's would be here, choose the kind of the function.
    import pyarrow as pa

    pack.__annotations__ = {"cells": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(pack, T.BinaryType())(*columns)


class Timed:
    """A rule on a stream: ``apply`` it, and read with ``rest`` what the end of input has left.
    ``at`` is the event time, with a watermark; ``order_by`` orders rows, beginning with it."""

    def __init__(self, rule, at: str, key: Names, order_by: Sequence[str]):
        self.rule, self.at, self.order_by = rule, at, list(order_by)
        self.key = [key] if isinstance(key, str) else list(key)

    def _bind(self, schema: T.StructType) -> tuple[Judge, T.StructType, int | None]:
        """What judges, what it puts out, and the place of event time if the state has it there as
        a number, which it has unless the rule reads it."""
        names, at = schema.fieldNames(), None
        if self.at not in self.rule.reads:
            at = names.index(self.at)
            schema = T.StructType([T.StructField(f.name, T.LongType()) if i == at else f for i, f in enumerate(schema.fields)])
        out = self.rule.bind(schema, self.key)
        return Judge(self.rule, [names.index(c) for c in self.key], [names.index(c) for c in self.order_by]), out, at

    def _unpack(self, pieces: DataFrame, unpack: Callable, out: T.StructType, at: int | None) -> DataFrame:
        schema = pieces.sparkSession.createDataFrame([], out).toArrow().schema

        def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow as pa

            for batch in found:
                for cells in zip(*(c.to_pylist() for c in batch.columns)):
                    rows = iter(unpack(*cells))
                    while part := list(islice(rows, MOST_ROWS)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

        rows = pieces.mapInArrow(batches, out)
        return rows if at is None or self.at not in out.names else rows.withColumn(self.at, F.timestamp_micros(self.at))

    def packed(self, stream: DataFrame, at: int | None) -> DataFrame:
        """Event time, bucket and the row as bytes, with event time as a number at its end, and at place ``at``.
        Spark drops late rows by the first, which is null (and so never late) beyond what pandas can hold. Rows are
        dealt before they are packed: a stream's files may be few."""
        spark = stream.sparkSession
        buckets = int(spark.conf.get(BUCKETS_CONF, str(BUCKETS)))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = stream.withColumns({AT: F.unix_micros(self.at), BUCKET: F.pmod(F.xxhash64(*self.key), F.lit(buckets))}).repartition(parts, BUCKET)
        cells = [AT if i == at else c for i, c in enumerate(stream.columns)]
        held = F.col(self.at).between(F.lit(FIRST_TIME).cast("timestamp"), F.lit(LAST_TIME).cast("timestamp"))
        # The metadata has the delay of the watermark.
        time = F.when(held, F.col(self.at)).alias(self.at, metadata=stream.schema[self.at].metadata)
        return dealt.select(time, BUCKET, _packer([*cells, AT]).alias(PACKED))

    def apply(self, stream: DataFrame) -> DataFrame:
        use_rocksdb(stream.sparkSession)
        judge, out, at = self._bind(stream.schema)
        keyed = self.packed(stream, at).groupBy(BUCKET)
        pieces = keyed.transformWithStateInPandas(statefulProcessor=PackedProcessor(judge, None), outputStructType=PIECE, outputMode="Append", timeMode="EventTime")
        return self._unpack(pieces, lambda rows: pickle.loads(rows), out, at)

    def rest(self, spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
        """What waits or is open in the state at ``checkpoint``, judged to the end; ``schema`` is
        that of the stream. Bounded for each bucket of keys like its state."""
        judge, out, at = self._bind(schema)
        path, fs = hadoop_path(spark, f"{checkpoint}/commits")

        def read(name: str) -> DataFrame:
            state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
            return state.select("key", *[(F.col("list_element.rows") if name == n else F.lit(None).cast("binary")).alias(n) for n in ("held", "waiting")])

        def ended(held: list, waiting: list) -> list[tuple]:
            states = dict(_unpacked((p,) for p in held))
            result = list(judge.judge(states, _unpacked((p,) for p in waiting), None))
            for state, queue in states.values():
                result += judge.rule.close(state, queue)[1]
            return result

        if not fs.exists(path):
            pieces = spark.createDataFrame([], "held array<binary>, waiting array<binary>")
        else:
            pieces = read("held").unionAll(read("waiting")).groupBy("key").agg(F.collect_list("held").alias("held"), F.collect_list("waiting").alias("waiting")).drop("key")
        return self._unpack(pieces, ended, out, at)


def in_order(at: str, key: Names, order_by: Sequence[str], inputs, init: tuple, step: Callable, outputs, keep: str | None = None) -> Timed:
    """A user's own rule, as in ``millrace.operators.stateful.fold_rows``."""
    return Timed(StepRule(inputs, init, step, outputs, keep), at, key, order_by)


def timed_gate(at: str, t: str, silence: int, key: Names, order_by: Sequence[str]) -> Timed:
    """Lets a row through, then none until ``silence`` has passed; ``t`` is the time as a number."""
    return in_order(at, key, order_by, [t], (None,), rules.gate_step(silence), [("_open", T.BooleanType())], "_open")


def rate_limit(at: str, t: str, number: int, period: int, key: Names, order_by: Sequence[str]) -> Timed:
    """Adds ``accepted``: at most ``number`` accepted rows in any ``period``."""
    return in_order(at, key, order_by, [t], (), rules.rate_limit_step(number, period), [("accepted", T.BooleanType())])


def capped_total(at: str, amount: str, cap: int, key: Names, order_by: Sequence[str], cap_first: bool = False) -> Timed:
    """Adds ``accepted`` and ``total``."""
    outputs = [("accepted", T.BooleanType()), ("total", T.LongType())]
    return in_order(at, key, order_by, [amount], (None,), rules.capped_total_step(cap, cap_first), outputs)


def set_changes(at: str, is_add: str, key: Names, order_by: Sequence[str]) -> Timed:
    """Adds ``changed`` and ``reply`` for add and remove commands of members (the key)."""

    def step(state, add):
        return (bool(add),), (bool(add) != state[0], "Added" if add else "Removed")

    return in_order(at, key, order_by, [is_add], (False,), step, [("changed", T.BooleanType()), ("reply", T.StringType())])


def last_seen(at: str, key: Names, order_by: Sequence[str], value: str, kind: T.DataType) -> Timed:
    """Adds ``previous``: the value of the row before, null for the first."""
    return in_order(at, key, order_by, [value], (None,), lambda state, v: ((v,), (state[0],)), [("previous", kind)])


def flag_duplicates(at: str, seq: str, start: str, key: Names, order_by: Sequence[str]) -> Timed:
    """Adds ``is_duplicate``: at or below the highest sequence number that this key has seen,
    which begins at column ``start``, and ``version``, the highest with this row. For several
    consumers see ``for_consumers``."""

    def step(state, number, first):
        high = first if state[0] is None else state[0]
        return (max(high, number),), (number <= high, max(high, number))

    return in_order(at, key, order_by, [seq, start], (None,), step, [("is_duplicate", T.BooleanType()), ("version", T.LongType())])


def for_consumers(stream: DataFrame, consumers: dict[str, int], name: str = "consumer", start: str = "initial") -> DataFrame:
    """Every row once for each consumer, with the version that it begins at: ``name`` is then part
    of the key."""
    each = F.array(*[F.struct(F.lit(c).alias(name), F.lit(v).cast("long").alias(start)) for c, v in consumers.items()])
    return stream.select("*", F.inline(each))


def sessions(at: str, gap: int, key: Names, order_by: Sequence[str], max_size: int | None = None, keep: str = "oldest", summary: Sequence[str] | None = None) -> Timed:
    """Sessions that end when nothing came for more than ``gap`` microseconds; rows exactly so far
    apart stay together. Numbered from 1 in ``session_no``."""
    return Timed(
        GroupRule(lambda g, t, _: g["last"] is None or (t is not None and t - g["last"] > gap), lambda g: None if g["last"] is None else g["last"] + gap, "session_no", None, max_size, keep, summary),
        at, key, order_by,
    )


def grouped_within(at: str, size: int, span: int, key: Names, order_by: Sequence[str], summary: Sequence[str] | None = None) -> Timed:
    """Groups that are full at ``size`` rows or close ``span`` after their first row, whichever
    comes first; numbered from 1 in ``group_no``. At most ``size`` rows are held."""
    return Timed(
        GroupRule(
            lambda g, t, _: g["n"] >= size or (t is not None and g["first"] is not None and t - g["first"] >= span),
            # A full group needs no wait beyond its last row.
            lambda g: g["last"] if g["n"] >= size else None if g["first"] is None else g["first"] + span - 1,
            "group_no", summary=summary,
        ),
        at, key, order_by,
    )


def unchanged_runs(at: str, prop: str, key: Names, order_by: Sequence[str], inactivity: int | None = None, max_size: int | None = None, keep: str = "oldest", summary: Sequence[str] | None = None) -> Timed:
    """Runs of rows with an unchanged property; with ``inactivity`` a longer pause also ends a
    run, by a timer if no row comes. Numbered from 1 in ``run_no``."""
    paused = lambda g, t: inactivity is not None and t is not None and g["last"] is not None and t - g["last"] > inactivity
    return Timed(
        GroupRule(lambda g, t, v: v != g["value"] or paused(g, t), lambda g: None if inactivity is None or g["last"] is None else g["last"] + inactivity, "run_no", prop, max_size, keep, summary),
        at, key, order_by,
    )


def merged_in_order(at: str, key: Names, order_by: Sequence[str]) -> Timed:
    """Rows of several sources (a union) as one sequence: ``position`` counts from 1 in order."""
    return in_order(at, key, order_by, [], (0,), lambda state: ((state[0] + 1,), (state[0] + 1,)), [("position", T.LongType())])

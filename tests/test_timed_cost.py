"""What a micro-batch costs the state of a stream in event time: calls by bucket, not by row or key."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from millrace.streaming import timed

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("k", T.DoubleType())])


class Held:
    def __init__(self, calls):
        self.calls, self.rows = calls, []

    def get(self):
        self.calls.append("get")
        return list(self.rows)

    def put(self, rows):
        self.calls.append("put")
        self.rows = list(rows)

    def appendList(self, rows):
        self.calls.append("append")
        self.rows += rows

    def clear(self):
        self.calls.append("clear")
        self.rows = []


class Value(Held):
    def get(self):
        self.calls.append("get")
        return self.rows or None

    update = Held.put


class Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def getValueState(self, *_):
        return Value(self.calls)

    def getListState(self, *_):
        return Held(self.calls)

    def registerTimer(self, ms):
        self.calls.append("timer")
        self.timers.add(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def _rows(n, keys):
    start = datetime(2024, 1, 1)
    return [(i, start + timedelta(seconds=i), float(i % keys), i * 1_000_000, 0) for i in range(n)]


def _cost(n, keys):
    judge, _, at = timed.sessions("ts", 5_000_000, "k", ["ts", "id"])._bind(SCHEMA)
    handle = Handle()
    processor = timed.TimedProcessor(judge, at)
    processor.init(handle)
    out = list(processor.handleInputRows((0,), iter(_rows(n, keys)), At(0)))
    out += processor.handleExpiredTimer((0,), At(n * 500), At(min(handle.timers)))
    rows = list(timed._unpacked(out))
    return handle, rows


def test_calls_do_not_grow_with_rows_or_keys():
    small, few = _cost(20, 2)
    large, many = _cost(2_000, 50)
    assert len(large.calls) == len(small.calls) <= 12
    assert len(large.timers) == 2
    # Two keys have a row every 2 s, one session each that goes on; fifty have one every 50 s, all over but the last 5 s.
    assert not few and [len(many), min(r[0] for r in many), max(r[0] for r in many)] == [995, 0, 994]


def test_a_key_is_one_group_however_its_number_is_written():
    name = timed._name_of([0])
    assert name((0.0,)) == name((-0.0,)) and name((float("nan"),)) == name((float("nan"),))
    assert len({name((v,)) for v in (None, "null", 1, "1")}) == 4

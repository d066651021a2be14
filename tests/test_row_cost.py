"""What a row costs a stream in event time: no cell goes through a row-wise function of its own."""

import json
import math

import pyarrow as pa
from pyspark.sql import types as T

from millrace.session import scratch_path
from millrace.streaming import runs, timed


def test_rows_come_out_in_arrow_batches(spark):
    schema = spark.createDataFrame([], "k int, ts timestamp, a array<string>, d decimal(10,2), s struct<x:double,y:date>").schema
    operator = timed.in_order("ts", "k", ["ts"], [], (0,), lambda s: ((s[0] + 1,), (s[0] + 1,)), [("n", T.LongType())])
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    df = spark.range(9).selectExpr(
        "CAST(id % 2 AS int) AS k",
        "timestamp_seconds(1704067200 + id * 10) AS ts",
        "IF(id % 2 = 0, array('a', NULL), NULL) AS a",
        "CAST(id / 4 AS decimal(10,2)) AS d",
        "IF(id = 3, NULL, struct(CAST('NaN' AS double) AS x, DATE'2024-01-01' AS y)) AS s",
    )
    df.coalesce(1).write.parquet(folder)
    runs.run_append(operator.apply(runs.file_stream(spark, folder, schema).withWatermark("ts", "20 seconds")), out, check)
    rest = operator.rest(spark, check, schema)
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BatchEvalPython" not in plan
    got = spark.read.parquet(out).unionByName(rest).drop("n")
    text = lambda rows: sorted(map(str, rows.collect()))
    assert text(got) == text(df) and {f.dataType.simpleString() for f in got.schema} == {f.dataType.simpleString() for f in df.schema}


def test_cells_are_those_of_arrow():
    for column in [pa.array([1, -2], pa.int32()), pa.array([1.5, math.inf]), pa.array([1, None]), pa.array(["x", None]), pa.array([True]), pa.array([], pa.int64())]:
        cells = timed._cells(column)
        assert cells == column.to_pylist() and [type(c) for c in cells] == [type(c) for c in column.to_pylist()]


def test_order_has_nulls_first():
    rows = [(2, "b"), (None, "a"), (2, None), (1, "z"), (None, None)]
    for places in ([0, 1], [0], [1]):
        assert timed._sorter(places)(rows) == sorted(rows, key=timed._sort_key(places))
    assert timed._sorter([0, 1])([(2, 1), (1, 2)]) == [(1, 2), (2, 1)]


def test_values_are_named_as_before():
    for value in ['é"\\\n ', "", None, 1, 1.0, True, [1, "a"]]:
        assert timed._text(value) == json.dumps(value, default=str)

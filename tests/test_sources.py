import os
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import decode
from millrace.plans.networks import BOROUGHS
from millrace.sources import journal, readers, writers


def test_trips(spark, tmp_path):
    line = "m{i},d{i},VTS,1,N,2013-01-01 00:0{i}:00,2013-01-01 00:1{i}:00,1,600,2.5,-73.97{i},40.75,-73.98,40.76"
    (tmp_path / "trips.csv").write_text("\n".join(line.format(i=i) for i in range(3)))
    rows = readers.read_trips(spark, str(tmp_path)).orderBy("medallion").collect()
    assert [r["pickup_lon"] for r in rows] == [-73.970, -73.971, -73.972]
    assert rows[2]["pickup_ts"].minute == 2 and rows[0]["trip_seconds"] == 600


def test_csv_line(spark):
    df = spark.createDataFrame([("a,1.5,x",), ("b",)], "line string")
    got = df.select(*decode.split_csv("line", name=(0, "string"), x=(1, "double"), n=(2, "int"))).collect()
    assert [tuple(r) for r in got] == [("a", 1.5, None), ("b", None, None)]


def test_json_array(spark, tmp_path):
    (tmp_path / "values.json").write_text("[" + ",\n".join(f'{{"value": {i}}}' for i in range(1, 26)) + "]")
    df = readers.read_json_array(spark, str(tmp_path / "values.json"), "value int")
    assert df.agg(F.count("*"), F.sum("value")).first() == (25, 325)


def test_geojson_round_trip(spark, tmp_path):
    (tmp_path / "b.geojson").write_text(BOROUGHS)
    features = readers.read_geojson(spark, str(tmp_path / "b.geojson")).withColumn("borough", F.col("properties")["borough"])
    assert features.count() == 4 and features.where("size(rings) = 2").count() == 1
    (tmp_path / "again.geojson").write_text(writers.feature_collections(features.drop("geometry").coalesce(1), ["borough"]).first()[0])
    again = readers.read_geojson(spark, str(tmp_path / "again.geojson"))
    assert sorted(map(str, again.select("id", "rings").collect())) == sorted(map(str, features.select("id", "rings").collect()))


def test_frames(spark):
    df = spark.createDataFrame([(1, "a\nbb\n"), (2, "c"), (3, "\nd"), (4, "")], "id int, text string")
    got = decode.frame_lines(df, "text", 1).orderBy("id", "frame_no").collect()
    assert [(r["id"], r["frame"], r["too_long"]) for r in got] == [
        (1, "a", False), (1, "bb", True), (2, "c", False), (3, "", False), (3, "d", False),
    ]


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_chunks(spark, kind):
    df = spark.createDataFrame([("abcdefg",), ("",), ("abc",)], "t string").withColumn("t", F.col("t").cast(kind))
    got = decode.chunk_text(df, "t", 3).select("chunk_no", F.col("chunk").cast("string")).orderBy("chunk_no", "chunk")
    assert [tuple(r) for r in got.collect()] == [(0, "abc"), (0, "abc"), (1, "def"), (2, "g")]


def test_copy_without_comments(spark, tmp_path):
    (tmp_path / "in.txt").write_text("1\n\n// no\n 2\n   \n")
    writers.copy_text(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == [" 2", "1"]


def test_journal_ends_at_the_first_empty_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(journal, "FOLDER_PARTITIONS", 2)
    numbers = [n for n in range(50) if not 20 <= n < 30 and n != 13]
    rows = [("p", n, f"e{n}") for n in numbers] + [("q", n, "x") for n in range(5)]
    path = str(tmp_path / "journal")
    journal.write_journal(spark.createDataFrame(rows, "persistence_id string, sequence_nr long, event string"), path, 10)
    read = lambda offset, who: [r["sequence_nr"] for r in journal.read_journal(spark, path, offset, 10, who).collect()]
    assert read(0, "p") == [n for n in range(20) if n != 13]
    assert read(12, "p") == [12, 14, 15, 16, 17, 18, 19]
    assert read(33, "p") == list(range(33, 50))
    assert read(25, "p") == []
    assert read(0, "q") == [0, 1, 2, 3, 4]
    plan = journal.read_journal(spark, path, 33, 10, "p")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*folder#\d+ >= 1", plan)
    assert sorted(f for f in os.listdir(path) if f.startswith("folder")) == ["folder=0", "folder=1", "folder=2"]
    both = [(r["persistence_id"], r["sequence_nr"]) for r in journal.read_journal(spark, path, 0, 10).collect()]
    assert both == sorted(both) and len(both) == 24
    assert re.search(r"persistence_id#\d+ = p\)", plan)


def test_paced_numbers(spark):
    rows = readers.number_source(spark, 3, 6, "2024-01-01 00:00:00", 1.5, 0.25).orderBy("value").collect()
    assert [r["value"] for r in rows] == [3, 4, 5]
    assert [str(r["ts"])[17:] for r in rows] == ["01.500000", "01.750000", "02"]


def test_counts(spark):
    df, seen = writers.counted(spark.range(10), "numbers")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 10


def test_telemetry(spark):
    text = '{"id": "t1", "timestamp": 5, "measurements": {"power": 1.5, "rotor_speed": 2, "wind_speed": 3}}'
    df = spark.createDataFrame([(text,), ("broken",)], "j string").select(decode.decode_telemetry(F.col("j")).alias("d"))
    rows = df.select("d.id", "d.measurements.power").collect()
    assert [tuple(r) for r in rows] == [("t1", 1.5), (None, None)]

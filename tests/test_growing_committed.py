"""Lines appended to known files, folders that join, and a sink that counts every row once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources import committed, growing
from millrace.streaming import runs


def test_ranges_cut_no_line(tmp_path):
    """Whatever the size of ranges, every line comes once, at its place."""
    rng = random.Random(3)
    for case in range(20):
        lines = ["é" * rng.randint(0, 9) + "x" * rng.choice([0, 1, 2, 30]) for _ in range(rng.randint(0, 40))]
        path = tmp_path / f"f{case}"
        path.write_bytes("".join(l + "\n" for l in lines).encode() + b"open")
        with open(path, "rb") as f:
            size = len(f.read())
        import pyarrow as pa

        end = growing.last_line_end(pa.OSFile(str(path)), size)
        assert end == size - 4
        for width in (1, 3, 7, 50, 10_000):
            got = [(o, l) for part in growing.ranges({}, {str(path): [end, size]}, width) for b in growing.lines_of(part) for o, l in zip(b["offset"].to_pylist(), b["frame"].to_pylist())]
            places, at = [], 0
            for l in lines:
                places.append((at, l))
                at += len(l.encode()) + 1
            assert got == places


def test_long_lines_pass_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK", 8)
    path = tmp_path / "f"
    path.write_bytes(b"a" * 50 + b"\n" + b"b" * 3 + b"\n" + b"c" * 20 + b"\n")
    got = [l for part in growing.ranges({}, {str(path): [76, 76]}, 16) for b in growing.lines_of(part) for l in b["frame"].to_pylist()]
    assert got == ["a" * 50, "b" * 3, "c" * 20]


def test_appended_lines_come_once(spark, tmp_path):
    logs, later = tmp_path / "logs", tmp_path / "later"
    (logs / "a").mkdir(parents=True)
    out, check = scratch_path(spark, "out"), scratch_path(spark, "check")

    def run(*folders, **options):
        stream = growing.growing_lines(spark, [str(f) for f in folders], 16, **options)
        runs.run_append(stream.select("frame", "offset"), out, check)
        return sorted(r["frame"] for r in spark.read.parquet(out).collect())

    (logs / "a" / "one.txt").write_text("first\nsecond\nunfin")
    assert run(logs) == ["first", "second"]
    with open(logs / "a" / "one.txt", "a") as f:
        f.write("ished\nthird\n")
    (logs / "b").mkdir()
    (logs / "b" / "two.txt").write_text("new folder\n")
    (logs / "b" / "_hidden").write_text("not this\n")
    assert run(logs) == ["first", "new folder", "second", "third", "unfinished"]
    later.mkdir()
    (later / "x.txt").write_text("joined\nrest")
    assert run(logs, later) == ["first", "joined", "new folder", "second", "third", "unfinished"]
    (logs / "a" / "one.txt").write_text("replaced\n")
    assert "replaced" in run(logs, later)
    assert "rest" in run(logs, later, unfinished="take")
    assert len(run(logs, later)) == 8


def test_rows_count_once_whatever_fails(spark, tmp_path):
    folder, out, check = scratch_path(spark, "in"), scratch_path(spark, "out"), scratch_path(spark, "check")
    schema = "n long, part int"
    flag = tmp_path / "fail"

    def checked(stream):
        @F.udf("long")
        def fail_once(n):
            if n == 55 and os.path.exists(str(flag)):
                raise ValueError("made to fail")
            return n

        return stream.select(fail_once("n").alias("n"), "part")

    def add(first, last):
        spark.range(first, last, 1, 4).select(F.col("id").alias("n"), F.spark_partition_id().alias("part")).write.mode("append").parquet(folder)

    def run():
        stream = runs.file_stream(spark, folder, spark.read.parquet(folder).schema)
        return committed.run_committed(checked(stream), out, check)

    def rows():
        return sorted(r["n"] for r in committed.read_committed(spark, out, schema).collect())

    add(0, 40)
    run()
    assert rows() == list(range(40))
    add(40, 80)
    flag.write_text("")
    with pytest.raises(Exception, match="made to fail"):
        run()
    assert rows() == list(range(40))
    flag.unlink()
    run()
    assert rows() == list(range(80))
    # The query is lost after the sink's commit: Spark runs the micro-batch again.
    commits = sorted((f for f in os.listdir(f"{check}/commits") if f.isdigit()), key=int)
    os.remove(f"{check}/commits/{commits[-1]}")
    os.remove(f"{check}/commits/.{commits[-1]}.crc")
    run()
    assert rows() == list(range(80))
    listed = {f for r in committed.manifests(spark, out).collect() for f in r["files"]}
    assert listed <= set(os.listdir(f"{out}/data"))
    assert sum(r["rows"] for r in committed.manifests(spark, out).collect()) == 80


def test_nothing_committed(spark):
    out = scratch_path(spark, "out")
    os.makedirs(f"{out}/manifest")
    assert committed.read_committed(spark, out, "n long").count() == 0

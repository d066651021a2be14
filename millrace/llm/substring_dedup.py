"""Suffix-array dedup: bytes in 200-byte strings that start at two places of the corpus go.

Every window of 200 bytes belongs to its *mark*: the least hash of its 64-byte strings. Equal
windows have equal marks, so windows that share a mark can be judged apart from all others. The
windows of a text that stand next to each other and share a mark form a *stretch*, cut after
``STRETCH`` windows; a text of n bytes has about n / 69 stretches.

A stretch whose mark stands nowhere else, itself included, has no copy. Stretches with equal bytes are copies of each
other as they are, however many there are; only one of them goes on. Where a mark has stretches
with different bytes, these are put in shards, whole marks together, and each shard's suffix
array (``suffix_sort``) gives the common prefix of each suffix with its neighbour: 200 or more, on
either side, is a window with a copy. A mark with more than ``SHARD_STRETCHES`` different
stretches (a phrase that stands in very many texts) would make a shard without bound: its windows
are counted by their own hash instead, which any number of tasks share.

Texts are UTF-8 bytes. Matches never leave a text. Removed bytes are judged on the input. Rows that
agree in doc_id and text are copies of each other, as any two rows with one text are. Null and
empty texts have no bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, table, texts
from millrace.llm.suffix_sort import permuted_common_prefix, suffix_array
from millrace.session import scratch_path, store

LENGTH = 200
PART = 64
STRETCH = 512
SHARD_STRETCHES = 2048
# The arrays that sort a shard take some 50 times its bytes, and should stay in a processor's cache.
SHARD_BYTES = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def part_hashes(data: bytes) -> np.ndarray:
    """Hash of each string of ``PART`` bytes, from eight bytes at a time, by doubling."""
    x = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), 8).copy().view("<u8").ravel()
    step = 8
    while step < PART:
        x = (x[:-step] * MIX) ^ (x[step:] * np.uint64(0xC2B2AE3D27D4EB4F))
        x ^= x >> np.uint64(29)
        step *= 2
    x *= MIX
    return x ^ (x >> np.uint64(32))


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and mark of each stretch, and whether its mark stands in it twice,
    so that a window may be equal to another one of the same stretch."""
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(bool)
    width = LENGTH - PART + 1
    hashes = part_hashes(data)
    marks = least_of(hashes, width)
    starts = np.concatenate([[0], np.flatnonzero(marks[1:] != marks[:-1]) + 1])
    counts = np.diff(np.append(starts, len(marks)))
    # Places that are the least of a window: no other lies between two of them with one value.
    edge = np.full(width - 1, ~np.uint64(0))
    least = np.flatnonzero(hashes == ~least_of(np.concatenate([edge, ~marks, edge]), width))
    again = least[:-1][hashes[least[:-1]] == hashes[least[1:]]]
    twice = np.zeros(len(starts), bool)
    twice[np.searchsorted(starts, np.minimum(again, len(marks) - 1), side="right") - 1] = True
    if counts.max() > STRETCH:
        pieces = -(-counts // STRETCH)
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        left = np.repeat(counts, pieces) - turn * STRETCH
        starts = np.repeat(starts, pieces) + turn * STRETCH
        twice = np.repeat(twice, pieces)
        counts = np.minimum(left, STRETCH)
    return starts, counts, marks[starts].view(np.int64), twice


def joined(of: list[np.ndarray], kind: type) -> pa.Array:
    return pa.array(np.concatenate(of) if of else np.empty(0, kind))


def all_stretches(docs: DataFrame) -> DataFrame:
    """doc, start, windows, mark, bytes (hash of the stretch), twice of every stretch."""

    def run(columns: list[list]) -> list:
        import xxhash

        out: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for doc, text in zip(*columns):
            data = text.encode("utf-8", "surrogatepass")
            starts, counts, marks, twice = stretches(data)
            if len(starts):
                view = memoryview(data)
                ends = (starts + counts + LENGTH - 1).tolist()
                content = np.array([xxhash.xxh64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), ends)], np.uint64)
                row = (np.full(len(starts), doc), starts, counts, marks, content.view(np.int64), twice)
                for column, value in zip(out, row):
                    column.append(value)
        return [*(joined(c, np.int64) for c in out[:5]), joined(out[5], bool)]

    return map_rows(docs.select("doc", "text"), "doc long, start long, windows long, mark long, bytes long, twice boolean", run)


def with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (doc, start, windows, mark, bytes, hot) with the bytes themselves as ``data``."""
    place = F.struct("start", "windows", "mark", "bytes", "hot")
    per_doc = wanted.groupBy("doc").agg(F.collect_list(place).alias("places"))
    held = docs.select("doc", "text").join(per_doc, "doc").select("text", "places")

    def run(columns: list[list]) -> list:
        out: list[list] = [[], [], [], []]
        for text, places in zip(*columns):
            data = text.encode("utf-8", "surrogatepass")
            for p in places:
                row = (p["mark"], p["bytes"], p["hot"], data[p["start"] : p["start"] + p["windows"] + LENGTH - 1])
                for column, value in zip(out, row):
                    column.append(value)
        return out

    return map_rows(held, "mark long, bytes long, hot boolean, data binary", run, 128)


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def in_shard(contents: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each stretch the runs of windows (from, to) that have a copy in the shard."""
    text = b"\x00".join(contents)
    order = suffix_array(np.frombuffer(text, np.uint8), 256)
    prefix, before = permuted_common_prefix(text, order, LENGTH)
    # A window lies within one stretch, so an equal one does: it ends before any border.
    inside = np.zeros(len(text), bool)
    sizes = np.array([len(c) for c in contents])
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    for first, size in zip(firsts.tolist(), sizes.tolist()):
        inside[first : first + size - LENGTH + 1] = True
    hit = (prefix >= LENGTH) & inside
    hit[before[hit]] = True
    return [runs(hit[a : a + n - LENGTH + 1]) for a, n in zip(firsts.tolist(), sizes.tolist())]


def shards(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows (mark, bytes, data), in order of mark, in shards: whole marks, one more only below ``SHARD_BYTES``."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        if size >= SHARD_BYTES and row[0] != held[-1][0]:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[2])
    if held:
        yield held


def copies_in_shards(found: DataFrame) -> DataFrame:
    """mark, bytes and runs of windows with a copy, by suffix arrays over whole marks."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.select("mark", "bytes", "data").repartition(parts, "mark").sortWithinPartitions("mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        return map(judged, shards(rows))

    def judged(held: list[tuple]) -> pa.RecordBatch:
        hits = [(m, b, r) for (m, b, _), r in zip(held, in_shard([h[2] for h in held])) if r]
        return as_runs(hits)

    return dealt.mapInArrow(run, "mark long, bytes long, runs array<struct<a:long,b:long>>")


def as_runs(hits: list[tuple]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    lists = [[{"a": a, "b": b} for a, b in h[2]] for h in hits]
    columns = [pa.array([h[0] for h in hits], pa.int64()), pa.array([h[1] for h in hits], pa.int64()), pa.array(lists, kind)]
    return pa.RecordBatch.from_arrays(columns, names=["mark", "bytes", "runs"])


def copies_by_window(found: DataFrame) -> DataFrame:
    """The same for marks with too many different stretches: windows counted by their hash."""

    def run(columns: list[list]) -> list:
        import xxhash

        out: list[list] = [[], [], [], []]
        for mark, content, data in zip(*columns):
            view = memoryview(data)
            n = len(data) - LENGTH + 1
            out[0].extend([mark] * n)
            out[1].extend([content] * n)
            out[2].extend(range(n))
            out[3].extend(xxhash.xxh64_intdigest(view[k : k + LENGTH]) - 2**63 for k in range(n))
        return out

    windows = map_rows(found.select("mark", "bytes", "data"), "mark long, bytes long, at long, window long", run, 64)
    windows = store(windows, "windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("_n")).where("_n > 1").select("window")
    hit = windows.join(twice, "window", "left_semi")
    one = F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))
    return hit.groupBy("mark", "bytes").agg(F.collect_list(one).alias("runs"))


def removed_ranges(docs: DataFrame) -> DataFrame:
    """doc and ranges (start, end) of its bytes that go; the ranges may overlap.

    ``docs`` has one row per document of doc (number), text."""
    found = store(all_stretches(docs), "stretches")
    marks = found.groupBy("mark").agg(F.count("*").alias("_n"), F.min("bytes").alias("_x"), F.max("bytes").alias("_y"), F.max("twice").alias("_twice"))
    marks = marks.where("_n > 1 OR _twice").select("mark", (F.expr("_x != _y OR _twice")).alias("mixed"))
    shared = store(found.drop("twice").join(marks, "mark"), "shared")
    contents = shared.groupBy("mark", "bytes").agg(
        F.count("*").alias("_n"), F.min(F.struct("doc", "start", "windows")).alias("one"), F.first("mixed").alias("mixed")
    )
    contents = store(contents, "contents")
    hot = contents.where("mixed").groupBy("mark").agg(F.count("*").alias("_n")).where(F.col("_n") > SHARD_STRETCHES)
    hot = hot.select("mark", F.lit(True).alias("hot"))
    wanted = contents.where("mixed").join(hot, "mark", "left")
    wanted = wanted.select("one.doc", "one.start", "one.windows", "mark", "bytes", F.coalesce("hot", F.lit(False)).alias("hot"))
    data = store(with_bytes(docs, wanted), "bytes")
    partly = copies_in_shards(data.where("NOT hot")).unionAll(copies_by_window(data.where("hot")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("windows").alias("b")))
    several = contents.where("_n > 1").select("mark", "bytes")
    gone = shared.join(several, ["mark", "bytes"], "left_semi").select("doc", "start", whole.alias("runs"))
    single = contents.where("_n = 1 AND mixed").select("mark", "bytes", "one.doc", "one.start")
    gone = gone.unionAll(single.join(partly, ["mark", "bytes"]).select("doc", "start", "runs"))
    ranges = F.transform("runs", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"] + LENGTH - 1).alias("b")))
    return gone.select("doc", F.explode(ranges).alias("r")).groupBy("doc").agg(F.collect_list("r").alias("ranges"))


def merged(ranges: list) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A table of doc_id, text and doc (a number of the row's own), bucketed by doc, and its name.

    Both joins with whole texts then find them in place: a text is shuffled once. The number is
    made of the row's place in the stored files, so that repeated rows differ."""
    spark = docs.sparkSession
    name = f"substring_dedup_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = texts(docs).withColumn("doc", F.monotonically_increasing_id())
    writer = whole.repartition(parts, "doc").write.bucketBy(parts, "doc").option("compression", "zstd")
    writer = writer.option("path", scratch_path(spark, "texts"))
    writer.format("parquet").saveAsTable(name)
    return spark.table(name), name


def remove_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left), kept_sha256; a row per row."""
    spark = docs.sparkSession
    rows, name = numbered(docs)
    held = rows.join(store(removed_ranges(rows), "ranges"), "doc", "left").select("doc_id", "text", "ranges")

    def run(columns: list[list]) -> list:
        out: list[list] = [columns[0], [], [], [], [], []]
        for text, ranges in zip(columns[1], columns[2]):
            data, gone = text.encode("utf-8", "surrogatepass"), merged(ranges)
            edges = [0, *(x for r in gone for x in r), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            row = (len(data), len(data) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest())
            for column, value in zip(out[1:], row):
                column.append(value)
        return out

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return map_rows(held, schema, run)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return remove_substrings(table(spark, folder, "documents")).drop("kept")

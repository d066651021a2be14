"""Token ids in binary record files, in the order of doc_id, with an offset index.

A record is ``length (8 bytes) | masked crc32 of those 8 bytes (4) | ids | masked crc32 of the
ids (4)``, all little-endian; ids have two or four bytes. Beside each record file lies an index
file with one entry of 21 bytes per record: doc_id (8), whether it is known (1), offset of the
record (8), number of ids (4). With the index, records can be read in any order.

Rows are dealt to shards by ranges of (doc_id, hash of the text, place in the input), null ids
first, and sorted within, so that rows with one id and also equal rows, however many, spread over
shards; the shards in order are the whole order. Their number follows that of the rows. Repeated
rows stay repeated. A null or empty text is a record with the end id alone. A very long text costs
its own size. Further columns are left out, an empty table gives an empty result.

A task writes files with names of its own and returns them as a row of the manifest; only what
the manifest names counts. A task that is run again leaves a file that no one names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table, texts
from millrace.llm.tokens import encoder, pieces
from millrace.session import scratch_path

END = 2
SHARD_ROWS = 50_000
LENGTH, CHECKSUM, ENTRY = "<Q", "<I", "<q?QI"
MANIFEST = "shard int, records string, offsets string, id_bytes int, n_records long, n_tokens long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, offset long"


def masked(data: bytes) -> int:
    """A crc32 that may itself be part of data with a crc32: turned by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(ids: bytes) -> bytes:
    length = struct.pack(LENGTH, len(ids))
    return b"".join((length, struct.pack(CHECKSUM, masked(length)), ids, struct.pack(CHECKSUM, masked(ids))))


def read_record(file) -> bytes:
    """The ids of the record at the file's position; raises if it is damaged."""
    head = file.read(struct.calcsize(LENGTH) + struct.calcsize(CHECKSUM))
    length = head[: struct.calcsize(LENGTH)]
    if len(head) < struct.calcsize(LENGTH) + struct.calcsize(CHECKSUM) or struct.unpack(CHECKSUM, head[struct.calcsize(LENGTH) :])[0] != masked(length):
        raise ValueError("damaged record length")
    ids = file.read(struct.unpack(LENGTH, length)[0])
    if struct.unpack(CHECKSUM, file.read(struct.calcsize(CHECKSUM)))[0] != masked(ids):
        raise ValueError("damaged record")
    return ids


def read_index(data: bytes) -> list[tuple[int | None, int, int]]:
    """(doc_id, offset, number of ids) of each record."""
    return [(i if known else None, offset, n) for i, known, offset, n in struct.iter_unpack(ENTRY, data)]


def open_folder(path: str):
    """The file system of a path that may have a scheme, and the path within it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def write_records(docs: DataFrame, folder: str, shards: int | None = None, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Write ``docs`` below ``folder``; returns the stored manifest, one row per shard. Without
    ``shards`` there are as many as shuffle partitions, or more if they would pass ``SHARD_ROWS``."""
    spark = docs.sparkSession
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // SHARD_ROWS))
    ordered = (
        texts(docs)
        .withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_hash", "_place")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "_place")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, files, at, n_records, n_tokens = TaskContext.get().partitionId(), None, 0, 0, 0
        coder = encoder(tokenizer)
        size = coder.dtype.itemsize
        last = end.to_bytes(size, "little")
        for batch in batches:
            for first, rows in pieces(batch.column(1)):
                piece = batch.slice(first, rows)
                if files is None:
                    system, root = open_folder(folder)
                    system.create_dir(root, recursive=True)
                    name = f"{root}/{shard:06d}-{uuid.uuid4().hex}"
                    files = system.open_output_stream(name + ".bin"), system.open_output_stream(name + ".idx")
                ids, ends = coder.encode(piece.column(1).to_pylist())
                data, a = ids.tobytes(), 0
                for number, b in zip(piece.column(0).to_pylist(), (ends * size).tolist()):
                    record = frame(data[a:b] + last)
                    n = (b - a) // size + 1
                    files[0].write(record)
                    files[1].write(struct.pack(ENTRY, number or 0, number is not None, at, n))
                    at, n_records, n_tokens, a = at + len(record), n_records + 1, n_tokens + n, b
        if files is not None:
            for f in files:
                f.close()
            base = name[len(root) + 1 :]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "records": [base + ".bin"],
                    "offsets": [base + ".idx"],
                    "id_bytes": pa.array([size], pa.int32()),
                    "n_records": pa.array([n_records], pa.int64()),
                    "n_tokens": pa.array([n_tokens], pa.int64()),
                }
            )

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: per record its place in the whole, size and checksum of its ids."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, root = open_folder(folder)
                with system.open_input_stream(f"{root}/{row['offsets']}") as f:
                    index = read_index(f.read())
                start, rows = row["base"], []
                with system.open_input_stream(f"{root}/{row['records']}", buffer_size=1 << 20) as f:
                    for number, offset, n in index:
                        ids = np.frombuffer(read_record(f), f"<u{row['id_bytes']}")
                        if len(ids) != n:
                            raise ValueError("index and record differ")
                        rows.append((number, start, n, zlib.crc32(ids.astype("<u4").tobytes()), row["shard"], offset))
                        start += n
                        if len(rows) == 10_000:
                            yield as_batch(rows)
                            rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return shards.repartition(tasks).mapInArrow(read, RESULT)


def offset_index(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, records (file), id_bytes, offset, n_tokens of every record, from the index files."""
    schema = "doc_id long, records string, id_bytes int, offset long, n_tokens long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, root = open_folder(folder)
                with system.open_input_stream(f"{root}/{row['offsets']}") as f:
                    index = read_index(f.read())
                n = len(index)
                columns = [pa.array(c, pa.int64()) for c in zip(*index)]
                yield pa.RecordBatch.from_arrays(
                    [columns[0], pa.array([row["records"]] * n), pa.array([row["id_bytes"]] * n, pa.int32()), *columns[1:]],
                    names=["doc_id", "records", "id_bytes", "offset", "n_tokens"],
                )

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks).mapInArrow(read, schema)


def read_at(index: DataFrame, folder: str, open_files: int = 64) -> DataFrame:
    """doc_id, ids (binary) of the records that ``index`` names, in its order, each read at its
    offset; any part of an offset index will do."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        files: dict = {}
        try:
            for batch in batches:
                for first in range(0, batch.num_rows, 256):
                    rows = batch.slice(first, 256).to_pylist()
                    out = []
                    for row in rows:
                        # The file used last stands last; the first one is closed beyond the bound.
                        file = files.pop(row["records"], None) or system.open_input_file(f"{root}/{row['records']}")
                        files[row["records"]] = file
                        if len(files) > open_files:
                            files.pop(next(iter(files))).close()
                        file.seek(row["offset"])
                        ids = read_record(file)
                        if len(ids) != row["n_tokens"] * row["id_bytes"]:
                            raise ValueError("index and record differ")
                        out.append(ids)
                    yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "ids"])
        finally:
            for file in files.values():
                file.close()

    return index.select("doc_id", "records", "id_bytes", "offset", "n_tokens").mapInArrow(read, "doc_id long, ids binary")


def read_shuffled(manifest: DataFrame, folder: str, seed: int, tasks: int | None = None) -> DataFrame:
    """All records in an order that only ``seed`` decides: the index is shuffled, not the records."""
    tasks = tasks or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = offset_index(manifest, folder).withColumn("_place", F.xxhash64(F.lit(seed), F.split("records", "-")[0], "offset"))
    return read_at(index.repartitionByRange(tasks, "_place").sortWithinPartitions("_place", "records", "offset"), folder)


def query(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "records")
    return read_records(write_records(table(spark, folder, "documents"), out), out)

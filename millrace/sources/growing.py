"""Files that grow, as a stream of lines: a data source whose offset maps each file to the bytes
read of it, beside its size.

Files below the given folders are found anew for each micro-batch, also in folders that were added
since, and each is read from where the last micro-batch ended up to its last line end. A line that
is not finished waits for its line end (``unfinished=take`` takes it as it is, for files that no
one writes to any more). What is new is planned as ranges of ``partitionBytes``, so one large file
is read by many tasks; a line belongs to the range in which it begins. The offsets live in the
checkpoint, so a query that is started again goes on where it was, also with more folders.

A file that became shorter was replaced and is read from its start. The offset has one entry per
file, and the driver lists the folders, as with Spark's own file sources. Names that begin with
``_`` or ``.`` are left out. Lines end with a line feed; bytes that are no UTF-8 are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, offset long, frame string"
PARTITION_BYTES = 64 << 20
BLOCK = 1 << 20


def open_path(path: str):
    """The file system of a path with or without a scheme, and the path within it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


class Range(InputPartition):
    """Lines of ``path`` that begin from ``first`` on and before ``last``; ``floor`` is a place
    where a line begins, ``end`` one where a line ends."""

    def __init__(self, path: str, floor: int, first: int, last: int, end: int):
        self.path, self.floor, self.first, self.last, self.end = path, floor, first, last, end


def ranges(start: dict, end: dict, size: int) -> list[Range]:
    out = []
    for path, (to, length) in sorted(end.items()):
        since = start.get(path, (0, 0))[0]
        if length < since:
            since = 0
        for first in range(since, to, size):
            out.append(Range(path, since, first, min(first + size, to), to))
    return out


def last_line_end(file, size: int, since: int = 0) -> int:
    """The place after the last line feed of the first ``size`` bytes, ``since`` if none."""
    at = size
    while at > since:
        begin = max(since, at - BLOCK)
        found = file.read_at(at - begin, begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    return since


def lines_of(part: Range) -> Iterator[pa.RecordBatch]:
    system, within = open_path(part.path)
    with system.open_input_file(within) as file:
        at = part.first
        if at > part.floor:
            # The line that runs into this range belongs to the one before.
            at -= 1
            while at < part.last:
                block = file.read_at(min(BLOCK, part.end - at), at)
                found = block.find(b"\n")
                if found >= 0:
                    at += found + 1
                    break
                at += len(block)
        # ``rest`` holds the beginning of a line, ``begun`` where it is; pieces are joined once.
        rest, begun, read = [], at, at
        while begun < part.last and read < part.end:
            block = file.read_at(min(BLOCK, part.end - read), read)
            read += len(block)
            if not block or b"\n" not in block:
                rest.append(block)
                if not block:
                    break
                continue
            *whole, tail = (b"".join(rest) + block).split(b"\n")
            places, frames = [], []
            for line in whole:
                if begun >= part.last:
                    break
                places.append(begun)
                frames.append(line.decode("utf-8", "replace"))
                begun += len(line) + 1
            yield as_batch(part.path, places, frames)
            rest = [tail]
        if rest and any(rest) and begun < part.last and read >= part.end:
            yield as_batch(part.path, [begun], [b"".join(rest).decode("utf-8", "replace")])


def as_batch(path: str, places: list[int], frames: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(frames, pa.string())], names=["path", "offset", "frame"])


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folders = json.loads(options["folders"])
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.take = options.get("unfinished", "wait") == "take"
        self.known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow.fs import FileSelector, FileType

        out = {}
        for folder in self.folders:
            system, within = open_path(folder)
            prefix = folder[: len(folder.rstrip("/")) - len(within.rstrip("/"))] if folder.rstrip("/").endswith(within.rstrip("/")) else ""
            for info in system.get_file_info(FileSelector(within, recursive=True, allow_not_found=True)):
                parts = info.path[len(within) :].strip("/").split("/")
                if info.type != FileType.File or any(p[:1] in ("_", ".") for p in parts):
                    continue
                path = prefix + info.path
                size, end = self.known.get(path, (-1, 0))
                if size != info.size:
                    end = info.size
                    if not self.take:
                        with system.open_input_file(info.path) as file:
                            end = last_line_end(file, info.size)
                    self.known[path] = info.size, end
                out[path] = [end, info.size]
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return ranges(start, end, self.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return lines_of(partition)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader({k.lower(): v for k, v in self.options.items()})


def growing_lines(spark: SparkSession, folders: Sequence[str], partition_bytes: int = PARTITION_BYTES, unfinished: str = "wait") -> DataFrame:
    """``(path, offset, frame)``: every line of every file below ``folders`` once, those appended
    to files already read and those of folders that join later included."""
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format("growing_lines").option("folders", json.dumps(list(folders)))
    return reader.option("partitionBytes", str(partition_bytes)).option("unfinished", unfinished).load()


def append_lines(df: DataFrame, column: str, folder: str, files: int) -> int:
    """Append a text and a line feed for each row to ``files`` files below ``folder``, each
    written by one task; returns the number of rows. Appending cannot be undone: a task that is
    run again repeats its lines, so this is for logs that nothing else may lose, and tests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, within = open_path(folder)
        system.create_dir(within, recursive=True)
        n = 0
        with system.open_append_stream(f"{within}/log-{TaskContext.get().partitionId():05d}.txt") as out:
            for batch in batches:
                for text in batch.column(0):
                    out.write(text.as_py().encode() + b"\n")
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    texts = df.select(F.col(column).cast("string").alias("text")).where(F.col("text").isNotNull())
    return texts.repartition(files).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0

"""A sink in two phases: tasks write files that no one reads, and a manifest per micro-batch
names those that count.

Each task writes a Parquet file under a new name and reports it. When all tasks of a micro-batch
have ended well, the driver writes ``manifest/<number>`` with their names, in one move. If one
fails, or an attempt is lost, its files are named nowhere; those that are reported are removed.
A micro-batch that comes again, because the query was lost between the sink's commit and Spark's
own, finds its manifest and leaves it: its new files are removed. So every row counts once,
whatever fails. ``read_committed`` takes only files that a manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.growing import open_path

FILE_BYTES = 256 << 20


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: str, file_bytes: int):
        self.folder, self.file_bytes = folder, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        system, root = open_path(self.folder)
        system.create_dir(f"{root}/data", recursive=True)
        files, rows, writer, held = [], 0, None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                files.append(f"{uuid.uuid4().hex}.parquet")
                writer, held = pq.ParquetWriter(system.open_output_stream(f"{root}/data/{files[-1]}"), batch.schema), 0
            writer.write_batch(batch)
            rows, held = rows + batch.num_rows, held + batch.nbytes
            if held >= self.file_bytes:
                writer.close()
                writer = None
        if writer is not None:
            writer.close()
        return Written(files, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        from pyarrow.fs import FileType

        system, root = open_path(self.folder)
        name = f"{root}/manifest/{batchId:012d}.json"
        system.create_dir(f"{root}/manifest", recursive=True)
        if system.get_file_info(name).type == FileType.File:
            self.abort(messages, batchId)
            return
        content = {"batch_id": batchId, "files": [f for m in messages if m for f in m.files], "rows": sum(m.rows for m in messages if m)}
        # Names that begin with an underscore are not read; the move makes the whole manifest appear at once.
        draft = f"{root}/manifest/_{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        system.move(draft, name)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        system, root = open_path(self.folder)
        for message in messages:
            for file in message.files if message else []:
                system.delete_file(f"{root}/data/{file}")


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        options = {k.lower(): v for k, v in self.options.items()}
        return CommittedWriter(options["folder"], int(options.get("filebytes", FILE_BYTES)))


def run_committed(stream: DataFrame, folder: str, checkpoint: str, file_bytes: int = FILE_BYTES) -> StreamingQuery:
    """Append the stream to ``folder`` in two phases, until what is available has been read."""
    stream.sparkSession.dataSource.register(CommittedFiles)
    writer = stream.writeStream.format("committed_files").outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.option("folder", folder).option("fileBytes", str(file_bytes)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """``(batch_id, files, rows)`` of every committed micro-batch."""
    return spark.read.schema("batch_id long, files array<string>, rows long").json(f"{folder}/manifest")


def read_committed(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """The rows of the files that manifests name. The driver holds their names, as it does for any
    folder that Spark reads."""
    files = [f"{folder}/data/{f}" for r in manifests(spark, folder).select("files").collect() for f in r["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)

"""Pack token sequences: first-fit decreasing over a tournament tree of free space.

Documents are encoded where they are read, dealt to tasks by a seeded hash of doc_id, text and
place in the input, and packed in groups of bounded size in the order of that hash, each on its
own: a task that runs again makes the same groups. A document longer than a sequence is cut into
full sequences and one rest; rests and short documents go, longest first, into the first sequence
of the group with room, which a tree of the largest free space finds in logarithmic steps. Then,
as documents may be cut anywhere, the last sequences (the emptiest) are taken apart to fill the
gaps in the others, until one is left that is not full: so a group pads one sequence at most.

Every id lies in exactly one piece. Null and empty texts are one piece with the end id. Repeated
rows are packed each for itself. Ties of size go by the order within the group. A very long text
costs its own ids, as full sequences never wait for a group. Further columns are left out, an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, texts
from millrace.llm.tokens import PIECE_ROWS, encoder, pieces

SEQUENCE = 2048
END = 1
GROUP = 2048
SEED = 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """Free space of numbered bins; each inner node holds the larger of its two."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with room for ``size``."""
        node = 1
        while node < self.leaves:
            node *= 2
            if self.free[node] < size:
                node += 1
        return node - self.leaves

    def take(self, bin_: int, size: int) -> None:
        node = bin_ + self.leaves
        self.free[node] -= size
        while node > 1:
            node //= 2
            self.free[node] = max(self.free[2 * node], self.free[2 * node + 1])


def pack(sizes: list[int], capacity: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, from, to) for items of at most ``capacity``."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        where = tree.first(sizes[item])
        tree.take(where, sizes[item])
        if where == len(bins):
            bins.append([])
        bins[where].append((item, 0, sizes[item]))
    return fill_gaps(bins, capacity)


def fill_gaps(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    used = [sum(b - a for _, a, b in pieces) for pieces in bins]
    order = sorted(range(len(bins)), key=lambda i: -used[i])
    low, high = 0, len(order) - 1
    while low < high:
        to, source = order[low], order[high]
        room = capacity - used[to]
        if not room:
            low += 1
        elif not bins[source]:
            high -= 1
        else:
            item, a, b = bins[source].pop()
            n = min(room, b - a)
            bins[to].append((item, a, a + n))
            used[to] += n
            used[source] -= n
            if a + n < b:
                bins[source].append((item, a + n, b))
    return [bins[i] for i in order if bins[i]]


def dealt(docs: DataFrame, parts: int, tokenizer: str | None, seed: int) -> DataFrame:
    """doc_id, _deal, ids (without end) by document, in the order of the seeded hash within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in pieces(batch.column(2)):
                piece = batch.slice(first, rows)
                ids, ends = encoder(tokenizer).encode(piece.column(2).to_pylist())
                data = pa.py_buffer(ids)
                places = pa.py_buffer(np.append(0, ends * ids.itemsize).astype("<i4"))
                column = pa.Array.from_buffers(pa.binary(), rows, [None, places, data])
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), column], names=["doc_id", "_deal", "ids"])

    place = F.xxhash64(F.lit(seed), "doc_id", "text", F.monotonically_increasing_id())
    encoded = texts(docs).select("doc_id", place.alias("_deal"), "text").mapInArrow(run, "doc_id long, _deal long, ids binary")
    return encoded.repartition(parts, "_deal").sortWithinPartitions("_deal")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, end: int = END, group: int = GROUP, seed: int = SEED
) -> DataFrame:
    """One row per piece: its document, place and size there, checksum, sequence and place there."""
    spark = docs.sparkSession
    rows = docs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (4 * group)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        kind = encoder(tokenizer).dtype
        last = int(end).to_bytes(kind.itemsize, "little")
        items: list[tuple] = []
        for batch in batches:
            for first in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(first, PIECE_ROWS)
                out: list[tuple] = []
                for doc, data in zip(piece.column(0).to_pylist(), piece.column(2)):
                    # Four bytes an id, as checksums are of these.
                    ids = np.frombuffer(data.as_py() + last, kind).astype("<u4").data.cast("B")
                    total = len(ids) // 4
                    full = total - total % sequence
                    for start in range(0, full, sequence):
                        out.append((doc, start, sequence, zlib.crc32(ids[4 * start : 4 * (start + sequence)]), total, number, 0))
                        number += 1
                    if total > full:
                        items.append((doc, full, ids[4 * full :], total))
                    if len(items) >= group:
                        out += close(items, number)
                        number, items = out[-1][5] + 1, []
                if out:
                    yield as_batch(out)
        if items:
            yield as_batch(close(items, number))

    def close(items: list[tuple], number: int) -> list[tuple]:
        out = []
        for bin_ in pack([len(i[2]) // 4 for i in items], sequence):
            at = 0
            for item, a, b in bin_:
                doc, start, ids, total = items[item]
                out.append((doc, start + a, b - a, zlib.crc32(ids[4 * a : 4 * b]), total, number, at))
                at += b - a
            number += 1
        return out

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return dealt(docs, parts, tokenizer, seed).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))

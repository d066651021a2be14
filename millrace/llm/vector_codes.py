"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

Each component x becomes the whole number floor(4096 * x), so that all sums and distances are
exact. A vector is cut into ``parts`` equal consecutive parts; each part position has a codebook,
fitted by rounds of assignment and averaging over all vectors. The nearest entry comes from
Orchard's method: every entry keeps the list of all entries by distance from it; a search walks
the list of the best entry so far, jumps to the list of any entry that is nearer, marks what it
has measured, and stops once the next entry of the list is more than twice as far from the best
one as the best one is from the point. By the triangle inequality nothing nearer, and no equal
entry of lower number, is left then.

Vectors that are null or hold null or non-finite components are dropped. Vectors of different
lengths have no distance from each other: each length has codebooks of its own. Where the length
is no multiple of ``parts``, the first parts are one component longer; an empty vector has the
code 0 and no error. Codebooks begin as the first kept rows by vec_id (null last, equal ids by
vector); with fewer rows than entries they are shorter. Repeated rows count each. Components
beyond 2^26 (of x: 16,384) count as 2^26, so that squares stay within 64 bits. Further columns
are left out; an empty table gives an empty result.

A round is one pass with sums per task and entry, so no vector is shuffled, and the driver holds
only codebooks: their size does not depend on the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.session import store

SCALE, LIMIT = 4096, 2**26
PARTS, ENTRIES, ROUNDS = 8, 16, 6
PIECE = 4096

# Codebooks of one length: for each part position an array of (entries, width).
Books = list[np.ndarray]


class Orchard:
    """Exact nearest entries by walking lists of neighbours."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None, :] - entries[None]) ** 2).sum(-1)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        self.measured = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the lower one of equals) and the squared distance, for
        each point. All points take a step of their walks at a time."""
        n, k = len(points), len(self.entries)
        best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least = ((points - self.entries[0]) ** 2).sum(1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        self.measured += n
        walking = np.arange(n)
        while len(walking):
            walking = walking[at[walking] < k]
            # Twice the distance is four times its square.
            walking = walking[self.gaps[best[walking], at[walking]] <= 4 * least[walking]]
            entry = self.order[best[walking], at[walking]]
            at[walking] += 1
            fresh = ~seen[walking, entry]
            rows, entry = walking[fresh], entry[fresh]
            seen[rows, entry] = True
            self.measured += len(rows)
            far = ((points[rows] - self.entries[entry]) ** 2).sum(1)
            nearer = (far < least[rows]) | ((far == least[rows]) & (entry < best[rows]))
            rows, entry = rows[nearer], entry[nearer]
            best[rows], least[rows], at[rows] = entry, far[nearer], 0
        return best, least


def bounds(length: int, parts: int) -> np.ndarray:
    """Where parts begin and end: equal sizes, the first ones longer by one if need be."""
    size, more = divmod(length, parts)
    return np.cumsum([0] + [size + (i < more) for i in range(parts)])


def whole_vectors(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, length, v (little-endian 32-bit components) of the rows that are kept."""
    kept = df.where(F.col(vector).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    schema = kept.select("vec_id", "label", F.lit(0).alias("length"), F.lit(b"").alias("v")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PIECE):
                piece = batch.slice(first, PIECE)
                size = piece.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(size)])
                # A null component arrives as not-a-number.
                x = piece.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
                good = bad[ends[1:]] == bad[ends[:-1]]
                x = np.clip(np.floor(np.where(np.isfinite(x), x, 0) * SCALE), -LIMIT, LIMIT).astype("<i4")
                data = [x[a:b].tobytes() for a, b, ok in zip(ends[:-1], ends[1:], good) if ok]
                piece = piece.filter(pa.array(good))
                sizes = pa.array(size[good], pa.int32())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), sizes, pa.array(data, pa.binary())], names=schema.names)

    return kept.mapInArrow(run, schema)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of each length, with their vectors as a matrix."""
    for first in range(0, batch.num_rows, PIECE):
        piece = batch.slice(first, PIECE)
        sizes = piece.column("length").to_numpy()
        for length in np.unique(sizes).tolist():
            rows = piece.filter(pa.array(sizes == length))
            data = np.frombuffer(b"".join(rows.column("v").to_pylist()), "<i4")
            yield length, rows, data.reshape(rows.num_rows, length).astype(np.int64)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, Books]:
    """Codebooks by length of vector, from the stored result of ``whole_vectors``."""
    first = Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    seeds = vectors.select("length", "vec_id", "v", F.row_number().over(first).alias("place")).where(F.col("place") <= entries)
    rows: dict[int, list[bytes]] = {}
    for r in seeds.orderBy("length", "place").collect():
        rows.setdefault(r["length"], []).append(bytes(r["v"]))
    books = {}
    for length, data in rows.items():
        start = np.frombuffer(b"".join(data), "<i4").reshape(len(data), length).astype(np.int64)
        cut = bounds(length, parts)
        books[length] = [start[:, a:b].copy() for a, b in zip(cut[:-1], cut[1:])]
    for _ in range(rounds):
        moved = False
        for r in _sums(vectors, books).collect():
            entry = books[r["length"]][r["part"]][r["entry"]]
            mean = r["total"] // r["n"]
            moved |= entry[r["place"]] != mean
            entry[r["place"]] = mean
        if not moved:
            # No later round would change anything either.
            break
    return books


def _sums(vectors: DataFrame, books: dict[int, Books]) -> DataFrame:
    """Sum and number of the parts nearest to each entry, by component."""
    names = ["length", "part", "entry", "place", "total", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = {length: [Orchard(b) for b in of] for length, of in books.items()}
        totals = {length: [np.zeros_like(b) for b in of] for length, of in books.items()}
        counts = {length: [np.zeros(len(b), np.int64) for b in of] for length, of in books.items()}
        for batch in batches:
            for length, _, x in _by_length(batch):
                cut = bounds(length, len(search[length]))
                for part, book in enumerate(search[length]):
                    points = x[:, cut[part] : cut[part + 1]]
                    near, _ = book.nearest(points)
                    np.add.at(totals[length][part], near, points)
                    counts[length][part] += np.bincount(near, minlength=len(book.entries))
        for length, of in counts.items():
            for part, count in enumerate(of):
                entry, place = np.meshgrid(np.flatnonzero(count), np.arange(totals[length][part].shape[1]), indexing="ij")
                entry, place = entry.ravel(), place.ravel()
                if len(entry):
                    same = np.ones(len(entry), np.int64)
                    columns = [same * length, same * part, entry, place, totals[length][part][entry, place], count[entry]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    sums = vectors.select("length", "v").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return sums.groupBy("length", "part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def digest(books: Books) -> str:
    """sha256 of all entries' components by part, entry and place, in decimal, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: dict[int, Books]) -> DataFrame:
    """vec_id, label, code (numbers of the nearest entries, two hex digits each), error (squared
    distances, summed over parts), codebooks_sha256."""
    schema = vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256")).schema
    names = {length: digest(of) for length, of in books.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = {length: [Orchard(b) for b in of] for length, of in books.items()}
        for batch in batches:
            for length, rows, x in _by_length(batch):
                cut = bounds(length, len(search[length]))
                code = np.zeros((len(x), len(search[length])), np.uint8)
                error = np.zeros(len(x), np.int64)
                for part, book in enumerate(search[length]):
                    code[:, part], far = book.nearest(x[:, cut[part] : cut[part + 1]])
                    error += far
                text = code.tobytes().hex()
                width = 2 * code.shape[1]
                codes = [text[i : i + width] for i in range(0, len(text), width)]
                columns = [rows.column("vec_id"), rows.column("label"), pa.array(codes), pa.array(error), pa.array([names[length]] * len(x))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.mapInArrow(run, schema)


def decode(code: str, books: Books) -> np.ndarray:
    """The whole-number vector that a code stands for."""
    return np.concatenate([book[int(code[2 * i : 2 * i + 2], 16)] for i, book in enumerate(books)])


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The codes of all vectors with the error summed over rows of equal label (nulls together)."""
    vectors = store(whole_vectors(df, vec_id, vector, label), "vectors")
    coded = store(encode(vectors, fit(vectors)), "codes")
    # Stored, so that the join reads plain shuffles or broadcasts a table of measured size; a
    # label that many rows share is summed before it.
    by_label = store(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return compress(table(spark, folder, "embeddings"))


def sql() -> str:
    """The same codes by plain comparison with every entry, for DuckDB."""
    parts = [
        f"""
        kept AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
                list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        cut AS (
            SELECT r, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) AS s(p)
        ),
        book0 AS (SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {ENTRIES})"""
    ]
    far = "list_sum(list_transform(range(len(x)), lambda i: (x[i + 1] - c[i + 1]) * (x[i + 1] - c[i + 1])))::BIGINT"
    for i in range(ROUNDS + 1):
        parts.append(f"near{i} AS (SELECT r, p, min(struct_pack(d := {far}, e := e)) AS m, any_value(x) AS x FROM cut JOIN book{i} USING (p) GROUP BY r, p)")
        if i < ROUNDS:
            parts.append(
                f"""
        sums{i} AS (
            SELECT p, m.e AS e, k, sum(x[k + 1])::BIGINT AS s, count(*) AS n
            FROM near{i}, (SELECT unnest(range(max(len(x)))) AS k FROM cut) WHERE k < len(x) GROUP BY ALL
        ),
        mean{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM sums{i} GROUP BY p, e),
        book{i + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{i} AS b LEFT JOIN mean{i} AS m USING (p, e))"""
            )
    parts.append(
        f"""
        digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}),
        coded AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)"""
    )
    steps = ",".join(s if "near" not in s.split(" AS ")[0] else s.replace(" AS (", " AS MATERIALIZED (", 1) for s in parts)
    return f"""
        WITH {steps}
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (r), digest
    """

"""Orchard's search and the codes against plain comparison with every entry."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import vector_codes


@pytest.mark.parametrize("entries,width,spread", [(1, 3, 5), (16, 8, 3), (16, 8, 1000), (40, 2, 4), (7, 1, 2), (5, 0, 1)])
def test_orchard_finds_the_lowest_of_the_nearest(entries, width, spread):
    """Small spreads give many ties and equal entries."""
    rng = np.random.default_rng(entries + spread)
    book = rng.integers(-spread, spread + 1, (entries, width))
    points = rng.integers(-spread, spread + 1, (500, width))
    near, far = vector_codes.Orchard(book).nearest(points)
    all_far = ((points[:, None, :] - book[None]) ** 2).sum(-1)
    assert (near == all_far.argmin(1)).all()
    assert (far == all_far.min(1)).all()


def test_orchard_measures_few_entries():
    rng = np.random.default_rng(5)
    book = rng.integers(-100_000, 100_000, (256, 2))
    points = np.repeat(book, 4, axis=0) + rng.integers(-50, 50, (1024, 2))
    search = vector_codes.Orchard(book)
    near, _ = search.nearest(points)
    assert (near == np.repeat(np.arange(256), 4)).all()
    assert search.measured < 0.5 * 1024 * 256


def plain(rows, parts=8, entries=16, rounds=6):
    """vec_id, code and error of vectors of one length, by whole-number loops."""
    rows = [(i, [int(np.floor(4096 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows.sort()
    width = len(rows[0][1]) // parts
    out = {}
    for p in range(parts):
        points = [(i, v[p * width : (p + 1) * width]) for i, v in rows]
        book = [v for _, v in points[:entries]]
        gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        pick = lambda v: min(range(len(book)), key=lambda e: (gap(v, book[e]), e))
        for _ in range(rounds):
            held = [pick(v) for _, v in points]
            for e in range(len(book)):
                mine = [v for (_, v), h in zip(points, held) if h == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
        for i, v in points:
            code, error, book_text = out.get(i, ("", 0, ""))
            out[i] = (code + f"{pick(v):02x}", error + gap(v, book[pick(v)]), book_text + "".join(f"{x}," for e in book for x in e))
    return {i: (c, e, hashlib.sha256(t[:-1].encode()).hexdigest()) for i, (c, e, t) in out.items()}


def test_codes(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()])
    got = vector_codes.compress(df).collect()
    assert {r["vec_id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in got} == want
    labels = dict(df.select("vec_id", "label").collect())
    sums = {}
    for i, (_, error, _) in want.items():
        sums[labels[i]] = sums.get(labels[i], 0) + error
    assert all(r["label_error"] == sums[labels[r["vec_id"]]] for r in got)


def test_odd_vectors(spark):
    """Dropped rows, null ids and labels, ties, lengths of their own, clashing names."""
    rows = [
        (1, [1.0] * 8, 1, "x"),
        (1, [1.0] * 8, 1, "y"),
        (2, [0.5] * 7 + [None], None, "x"),
        (3, [0.5] * 7 + [float("nan")], None, "x"),
        (4, [0.5] * 7 + [float("-inf")], 2, "x"),
        (5, None, 2, "x"),
        (None, [-0.3] * 8, None, "x"),
        (6, [0.25] * 10, None, "x"),
        (7, [], None, "x"),
        (8, [1e300] * 8, 3, "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, length string")
    got = {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in vector_codes.compress(df).collect()}
    assert got == {
        (1, "00" * 8, 0, 0),
        (None, "03" * 8, 0, 0),
        (6, "00" * 8, 0, 0),
        (7, "00" * 8, 0, 0),
        (8, "02" * 8, 0, 0),
    }
    books = vector_codes.fit(vector_codes.whole_vectors(df, "vec_id", "embedding", "label"))
    assert vector_codes.decode("03" * 8, books[8]).tolist() == [-1229] * 8
    assert vector_codes.compress(df.where(F.lit(False))).collect() == []

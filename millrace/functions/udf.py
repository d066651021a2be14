"""User functions: parallel maps, chunk functions, aggregates, table functions.

Built-in column functions are faster wherever they suffice; these move Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.ordered import one_nan

Names = str | Sequence[str]

# Keys that a task holds while it combines.
_HELD_KEYS = 100_000


def map_ordered(df: DataFrame, fn: Callable[[pd.Series], pd.Series], column: str, out: str, kind: str) -> DataFrame:
    """A parallel map that keeps each result beside its row (a scalar pandas UDF)."""
    return df.withColumn(out, F.pandas_udf(fn, kind)(column))


def map_unordered(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, tasks: int | None = None) -> DataFrame:
    """A parallel map over batches, in any order; ``tasks`` spreads skewed input first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    source = df.repartition(tasks) if tasks else df
    return source.mapInPandas(run, schema)


def map_chunks(df: DataFrame, n: int, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` over chunks of up to ``n`` rows, cut from the Arrow batches of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= n:
                joined = pd.concat(held, ignore_index=True)
                rest = rows % n
                for start in range(0, rows - rest, n):
                    yield fn(joined.iloc[start : start + n])
                held, rows = [joined.iloc[rows - rest :]], rest
        if rows:
            yield fn(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


def monoid_aggregate(
    df: DataFrame, value: str, empty: Any, combine: Callable[[Any, Any], Any], kind: T.DataType, key: Names = (), out: str = "result"
) -> DataFrame:
    """A user aggregate given by its empty value and an associative, commutative combine.

    Each task first combines its own rows per key, so the shuffle carries at most one
    partial result per key and task (or per ``_HELD_KEYS`` keys); these are combined
    while they stream by, sorted by key. No list of a group's rows is built.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.select(*keys, F.col(value).cast(kind).alias(out))
    schema = rows.schema
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.names

    def batch_of(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], type=t) for i, t in enumerate(types)], names=names)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Any]]:
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in names]):
                yield one_nan(row[:-1]), row[-1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for k, v in values(batches):
            if k not in held and len(held) >= _HELD_KEYS:
                yield batch_of([(*k2, v2) for k2, v2 in held.items()])
                held = {}
            held[k] = combine(held.get(k, empty), v)
        yield batch_of([(*k, v) for k, v in held.items()])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc, done = None, empty, []
        for k, v in values(batches):
            if k != current:
                if current is not None:
                    done.append((*current, acc))
                    if len(done) >= _HELD_KEYS:
                        yield batch_of(done)
                        done = []
                current, acc = k, empty
            acc = combine(acc, v)
        if current is not None:
            done.append((*current, acc))
        yield batch_of(done)

    partials = rows.mapInArrow(partial, schema)
    by_key = partials.repartition(*keys).sortWithinPartitions(*keys) if keys else partials.repartition(1)
    return by_key.mapInArrow(final, schema)


def explode_with(df: DataFrame, fn: Callable[[Column], Column], column: str, out: str) -> DataFrame:
    """One to many: a row per element of the array that ``fn`` builds."""
    return df.withColumn(out, F.explode(fn(F.col(column))))


def piece(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Several transformations as one reusable piece for ``df.transform``."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def with_context(df: DataFrame, context: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run row-wise ``work`` on the other columns while ``context`` is carried beside them
    as one struct column that ``work`` passes through untouched."""
    data = [c for c in df.columns if c not in context]
    done = work(df.select(*data, F.struct(*context).alias("_context")))
    return done.select(*[c for c in done.columns if c != "_context"], "_context.*")

"""Row shaping: map, filter, explode, repeat, error split, take and drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggs import retain
from millrace.ordered import Ordered

Names = str | Sequence[str]


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def keep(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def collect_cases(df: DataFrame, cases: Sequence[tuple[Column, Column]], out: str) -> DataFrame:
    """Partial map: the first matching case gives ``out``; rows without a match are dropped."""
    expr = None
    matched = F.lit(False)
    for condition, value in cases:
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
        matched = matched | F.coalesce(condition, F.lit(False))
    return df.where(matched).withColumn(out, expr)


def flatten(df: DataFrame, array: str, out: str | None = None) -> DataFrame:
    """One row per array element; empty arrays give none."""
    out = out or array
    others = [c for c in df.columns if c != array and c != out]
    return df.select(*others, F.explode(array).alias(out))


def repeat(df: DataFrame, n: int | Column, copy_no: str | None = None) -> DataFrame:
    """Every row ``n`` times; ``copy_no`` names a column numbering the copies from 1."""
    times = F.lit(n) if isinstance(n, int) else n
    copies = F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))
    out = df.select("*", F.explode(copies).alias(copy_no or "_copy"))
    return out if copy_no else out.drop("_copy")


def duplicate(df: DataFrame, copy_no: str | None = None) -> DataFrame:
    return repeat(df, 2, copy_no)


def split_results(df: DataFrame, error: Column, column: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without error, rows with error text). Both are filters over the same input."""
    checked = df.withColumn(column, error)
    return checked.where(F.col(column).isNull()).drop(column), checked.where(F.col(column).isNotNull())


def above_running_average(
    df: DataFrame, value: str, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Rows whose value is at least the mean of all so far, itself included. Compared as
    ``value * count >= sum``, which needs no division."""
    o = Ordered.of(df, key, order_by, limit).running({"_n": ("count", value), "_sum": ("sum", value)})
    return o.where(F.col(value) * F.col("_n") >= F.col("_sum")).drop("_n", "_sum")


def safe_divide(df: DataFrame, numerator: str, denominator: str, out: str, on_error: str = "resume") -> DataFrame:
    """Division by zero either drops the row or stops the job."""
    if on_error == "resume":
        quotient = F.try_divide(F.col(numerator), F.col(denominator))
        return df.withColumn(out, quotient).where(F.col(out).isNotNull())
    zero = F.raise_error(F.lit("division by zero"))
    return df.withColumn(out, F.when(F.col(denominator) == 0, zero).otherwise(F.col(numerator) / F.col(denominator)))


def safe_cast(df: DataFrame, column: str, to: str, on_error: str = "resume") -> DataFrame:
    """Cast in place. A non-null value that cannot be cast drops its row or stops the job."""
    if on_error == "stop":
        return df.withColumn(column, F.expr(f"CAST({column} AS {to})"))
    cast = F.col(column).try_cast(to)
    return df.withColumn("_cast", cast).where(F.col(column).isNull() | F.col("_cast").isNotNull()).withColumn(
        column, F.col("_cast")
    ).drop("_cast")


def take_while(
    df: DataFrame, predicate: Column, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Rows before the first one that fails the predicate (or ends the stream)."""
    failed = ~F.coalesce(predicate, F.lit(False))
    o = Ordered.of(df, key, order_by, limit).running({"_ended": ("or", failed)})
    return o.where(~F.col("_ended")).drop("_ended")


def drop_while(
    df: DataFrame, predicate: Column, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Rows from the first one that fails the predicate on."""
    failed = ~F.coalesce(predicate, F.lit(False))
    o = Ordered.of(df, key, order_by, limit).running({"_begun": ("or", failed)})
    return o.where(F.col("_begun")).drop("_begun")


def drop_within(
    df: DataFrame, ts: str, span: str, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Rows at least ``span`` after the first of their key. ``order_by`` starts with ``ts``."""
    o = Ordered.of(df, key, order_by, limit).running({"_first": ("min", ts)})
    return o.where(F.col(ts) >= F.expr(f"_first + INTERVAL {span}")).drop("_first")


def take(df: DataFrame, n: int, order_by: Names, key: Names = ()) -> DataFrame:
    """The first ``n`` rows (of each key). Each task passes on ``n`` rows of a key at most, as
    retention does; see there for large ``n``."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if not key:
        return df.orderBy(*order).limit(n)
    return retain(df, n, key, order)


def drop(df: DataFrame, n: int, order_by: Names, key: Names = (), limit: int | None = None) -> DataFrame:
    """All but the first ``n`` rows (of each key)."""
    return Ordered.of(df, key, order_by, limit).position("_n").where(F.col("_n") > n).drop("_n")

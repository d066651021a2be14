"""Join-like operators: lookups, 1:1 merge join, zip, latest-per-tick, as-of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.ordered import Ordered
from millrace.session import broadcast_bytes, broadcast_rows

Names = str | Sequence[str]


def _names(x: Names) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def lookup(left: DataFrame, right: DataFrame, on: Names | Column, how: str = "left", max_rows: int | None = None) -> DataFrame:
    """Equi-join of many rows with a reference table.

    The reference side is counted and measured, up to the bound of rows only, and broadcast
    when it is within the bounds of rows and of bytes (its rows as JSON text, which is more than
    they take in memory). Beyond them it is a shuffled join, whose hot keys adaptive execution
    splits.
    """
    spark = left.sparkSession
    bound = max_rows if max_rows is not None else broadcast_rows(spark)
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in right.columns]))))
    rows, held = right.limit(bound + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    if rows <= bound and held <= broadcast_bytes(spark):
        right = F.broadcast(right)
    return left.join(right, on, how)


def merge_join(
    left: DataFrame,
    right: DataFrame,
    on: Names,
    left_order: Names,
    right_order: Names,
    mode: str = "pairwise",
    limit: int | None = None,
) -> DataFrame:
    """Sorted merge join. On equal keys both sides move on, so the n-th duplicate of the
    left pairs with the n-th of the right; ``mode='relational'`` pairs all with all.

    The row number is part of the join key, so duplicates of a hot key spread out.
    """
    on = _names(on)
    if mode == "relational":
        return left.join(right, on)
    l = Ordered.of(left, on, left_order, limit).position("_nth").df
    r = Ordered.of(right, on, right_order, limit).position("_nth").df
    return l.join(r, [*on, "_nth"]).drop("_nth")


def zip_rows(
    sides: Sequence[tuple[DataFrame, Names]], key: Names = (), out: str = "idx", limit: int | None = None
) -> DataFrame:
    """Positional zip of two or more inputs, ``[(df, order_by), ...]``; ends with the
    shortest. With ``key``, zipped within each key."""
    key = _names(key)
    numbered = [Ordered.of(df, key, order, limit).position(out).df for df, order in sides]
    return reduce(lambda a, b: a.join(b, [*key, out]), numbered)


def latest_per_tick(
    sources: Mapping[str, DataFrame],
    ts: str,
    value: str,
    unique: str,
    tick: str,
    key: Names = (),
    pick: str = "latest",
) -> DataFrame:
    """One row per tick in which every source had an element: the latest (or earliest)
    value of each, in columns named after the sources."""
    key = _names(key)
    choose = {"latest": F.max_by, "earliest": F.min_by}[pick]
    per_source = []
    for name, df in sources.items():
        per_source.append(
            df.groupBy(*key, F.window(ts, tick).alias("_w"))
            .agg(choose(value, F.struct(ts, unique)).alias(name))
            .select(*key, F.col("_w.start").alias("tick"), name)
        )
    return reduce(lambda a, b: a.join(b, [*key, "tick"]), per_source)


def asof(
    fast: DataFrame,
    slow: DataFrame,
    ts: str,
    unique: str,
    values: Sequence[str],
    key: Names = (),
    limit: int | None = None,
) -> DataFrame:
    """Every fast row with the slow values current at its time (same instant included),
    null before the first. ``unique`` identifies rows on both sides."""
    key = _names(key)
    own = fast.columns
    slow_part = slow.select(
        *key,
        F.col(ts),
        F.lit(0).alias("_side"),
        F.col(unique).alias("_uid"),
        F.struct(*values).alias("_slow"),
        F.lit(None).cast(fast.select(F.struct("*")).schema[0].dataType).alias("_fast"),
    )
    fast_part = fast.select(
        *key,
        F.col(ts),
        F.lit(1).alias("_side"),
        F.col(unique).alias("_uid"),
        F.lit(None).cast(slow.select(F.struct(*values)).schema[0].dataType).alias("_slow"),
        F.struct("*").alias("_fast"),
    )
    both = Ordered.of(fast_part.unionByName(slow_part), key, [ts, "_side", "_uid"], limit)
    current = both.running({"_current": ("last", "_slow")}).where(F.col("_side") == 1)
    return current.select(
        *[F.col(f"_fast.{c}").alias(c) for c in own], *[F.col(f"_current.{v}").alias(f"slow_{v}") for v in values]
    )


def sums_per_tick(
    left: DataFrame, right: DataFrame, ts: str, value: str, tick: str, key: Names = ()
) -> DataFrame:
    """Sum of each side between ticks, paired where both sides had elements."""
    key = _names(key)

    def sums(df: DataFrame, out: str) -> DataFrame:
        return (
            df.groupBy(*key, F.window(ts, tick).alias("_w"))
            .agg(F.sum(value).alias(out))
            .select(*key, F.col("_w.start").alias("tick"), out)
        )

    return sums(left, "left_sum").join(sums(right, "right_sum"), [*key, "tick"])


def enrich(commands: DataFrame, reference: DataFrame, on: str, flag: str = "known", max_rows: int | None = None) -> DataFrame:
    """Commands with the reference columns; unknown ones stay, with ``flag`` false."""
    marked = reference.dropDuplicates([on]).withColumn("_hit", F.lit(True))
    return lookup(commands, marked, on, "left", max_rows).withColumn(flag, F.col("_hit").isNotNull()).drop("_hit")


def in_set(df: DataFrame, column: str, members: DataFrame | Sequence, max_rows: int | None = None) -> DataFrame:
    """Rows whose value is a member."""
    if isinstance(members, DataFrame):
        return lookup(df, members.toDF(column).distinct(), column, "left_semi", max_rows)
    return df.where(F.col(column).isin(list(members)))


def not_in_set(df: DataFrame, column: str, members: DataFrame | Sequence, max_rows: int | None = None) -> DataFrame:
    """Rows whose value is not a member; a missing value is no member."""
    if isinstance(members, DataFrame):
        return lookup(df, members.toDF(column).distinct(), column, "left_anti", max_rows)
    return df.where(~F.coalesce(F.col(column).isin(list(members)), F.lit(False)))


def flag_member(
    df: DataFrame, column: str, members: DataFrame | Sequence, flag: str, max_rows: int | None = None
) -> DataFrame:
    """Every row, with a membership column."""
    if isinstance(members, DataFrame):
        return enrich(df, members.toDF(column), column, flag, max_rows)
    return df.withColumn(flag, F.coalesce(F.col(column).isin(list(members)), F.lit(False)))


def combine_results(results: Mapping[str, DataFrame], key: Names) -> DataFrame:
    """Independent results ``(key, value, errors)`` joined per key: all values in their
    own columns, or, when any failed, null values and every error."""
    key = _names(key)
    parts = [
        df.select(*key, F.col("value").alias(name), F.col("errors").alias(f"_e_{name}"))
        for name, df in results.items()
    ]
    joined = reduce(lambda a, b: a.join(b, key), parts)
    errors = F.concat(*[F.col(f"_e_{name}") for name in results])
    valid = F.size("errors") == 0
    return (
        joined.withColumn("errors", errors)
        .withColumns({name: F.when(valid, F.col(name)) for name in results})
        .drop(*[f"_e_{name}" for name in results])
    )

"""Union, ordered merge and duplicate removal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ordered import Ordered
from millrace.session import store

Names = str | Sequence[str]


def merge(*sources: DataFrame) -> DataFrame:
    """All rows of all sources."""
    return reduce(DataFrame.unionByName, sources)


def merge_sorted(
    left: DataFrame, right: DataFrame, order_by: Names, out: str = "merged_no", limit: int | None = None
) -> DataFrame:
    """Two ordered inputs as one; at equal keys the right side goes first. ``out`` numbers
    the merged rows."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(0)))
    # all but the last order column are compared before the side
    by = [*order[:-1], "_side", order[-1]] if len(order) > 1 else [*order, "_side"]
    return Ordered.of(both, [], by, limit).position(out).df.drop("_side")


def interleave(
    left: DataFrame,
    right: DataFrame,
    left_order: Names,
    right_order: Names,
    out: str = "merged_no",
    limit: int | None = None,
) -> DataFrame:
    """a, b, a, b, ... and then the rest of the longer input.

    The place of a row follows from its own number and the length of the other side, so
    nothing is sorted twice. The numbered sides are stored, and counted as stored.
    """
    l = store(Ordered.of(left, [], left_order, limit).position("_n").df, "left")
    r = store(Ordered.of(right, [], right_order, limit).position("_n").df, "right")
    n_left, n_right = l.count(), r.count()
    place_left = F.col("_n") + F.least(F.col("_n") - 1, F.lit(n_right))
    place_right = F.col("_n") + F.least(F.col("_n"), F.lit(n_left))
    return l.withColumn(out, place_left).unionByName(r.withColumn(out, place_right)).drop("_n")


def heartbeats(df: DataFrame, ts: str, interval_seconds: int, flag: str = "is_heartbeat") -> DataFrame:
    """Adds an empty row for every interval, between the first and the last, without data.

    Ticks come from ``spark.range``, so a long span needs no large array.
    """
    spark = df.sparkSession
    micros, interval = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})", interval_seconds * 1_000_000
    # Rounded down also before 1970.
    tick = F.expr(f"({micros} - pmod({micros}, {interval})) div {interval}")
    used = df.select(tick.alias("_tick")).distinct()
    span = used.agg(F.min("_tick").alias("lo"), F.max("_tick").alias("hi")).first()
    data = df.withColumn(flag, F.lit(False))
    if span["lo"] is None:
        return data
    idle = spark.range(span["lo"], span["hi"] + 1).toDF("_tick").join(used, "_tick", "left_anti")
    at = F.expr(f"timestampadd(SECOND, _tick * {interval_seconds}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    beats = idle.select(at.cast(df.schema[ts].dataType).alias(ts), F.lit(True).alias(flag))
    return data.unionByName(beats, allowMissingColumns=True)


def distinct_first(df: DataFrame, value: Names, order_by: Names) -> DataFrame:
    """The first occurrence of each value, as an aggregate that combines before the shuffle."""
    values = [value] if isinstance(value, str) else list(value)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    first = df.groupBy(*values).agg(F.min_by(F.struct("*"), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def distinct_in_last(
    df: DataFrame, value: str, order_by: Names, n: int, key: Names = (), limit: int | None = None
) -> DataFrame:
    """Drops a row whose value occurred in one of the ``n - 1`` rows before it.

    Two distances instead of a list per row: each row's number, then the number of the
    previous row with the same value.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # Stored between the two layouts, so that the second does not compute the first again.
    numbered = store(Ordered.of(df, keys, order_by, limit).position("_n").df, "numbered")
    o = Ordered.of(numbered, [*keys, value], "_n", limit).bounded(lambda w: {"_prev": F.lag("_n").over(w)}, before=1)
    return o.where(F.col("_prev").isNull() | (F.col("_n") - F.col("_prev") >= n)).drop("_n", "_prev")


def dedup_merge(
    left: DataFrame,
    right: DataFrame,
    value: str,
    left_order: Names,
    right_order: Names,
    n: int,
    limit: int | None = None,
) -> DataFrame:
    """Both inputs interleaved, then values repeated within ``n`` rows dropped."""
    both = interleave(left, right, left_order, right_order, "merged_no", limit)
    return distinct_in_last(both, value, "merged_no", n, limit=limit)


def flag_duplicates(
    df: DataFrame,
    seq: str,
    order_by: Names,
    initial_versions: Mapping[str, int],
    key: Names = (),
    limit: int | None = None,
) -> DataFrame:
    """For each row and each consumer: is its sequence number at or below the highest
    that the consumer has seen? Adds ``consumer``, ``is_duplicate`` and ``version``.

    The highest number so far is the same for all consumers but for their start value,
    so it is computed once and the (configured, few) consumers are added row by row.
    """
    o = Ordered.of(df, key, order_by, limit).running({"_high": ("max", seq)}, exclusive=True)
    consumers = F.array(
        *[F.struct(F.lit(c).alias("consumer"), F.lit(v).alias("start")) for c, v in initial_versions.items()]
    )
    rows = o.df.withColumn("_c", F.explode(consumers))
    seen = F.greatest(F.col("_c.start").cast("long"), F.col("_high"))
    return rows.select(
        *df.columns,
        F.col("_c.consumer").alias("consumer"),
        (F.col(seq) <= seen).alias("is_duplicate"),
        F.greatest(seen, F.col(seq)).alias("version"),
    )

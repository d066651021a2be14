"""Functions over ordered rows: moving averages, differences, running state.

Every function takes ``key`` (may be empty: one order over all rows) and ``order_by``,
which has to end with a unique column. Groups of any size are fine, see
``millrace.ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.ordered import Ordered

Names = str | Sequence[str]

# Spark evaluates each row of a sliding frame anew; from this frame size on two running sums
# over blocks of as many rows are cheaper.
BLOCK_SUM_FROM = 64


def _moving_sum(o: Ordered, value: str, n: int, out: str) -> Ordered:
    """Sum of the last ``n`` rows, and ``_n``, the row number. Nulls are left out, and a NaN or an
    infinity counts in the frames that hold it, for any ``n`` and layout.

    A long frame is the end of one block of ``n`` rows and the beginning of the next; both are
    running sums within a block, so nothing is subtracted."""
    o = o.position("_n")
    if n < BLOCK_SUM_FROM:
        return o.bounded(lambda w: {out: F.sum(value).over(w.rowsBetween(-(n - 1), 0))}, before=n - 1)

    def within_blocks(w: WindowSpec) -> dict[str, Column]:
        block = Window.partitionBy(*o.groups, F.expr(f"(_n - 1) div {n}")).rowsBetween(Window.unboundedPreceding, 0)
        order = o.order_by
        return {
            "_head": F.sum(value).over(block.orderBy(*[F.asc(c) for c in order])),
            "_tail": F.sum(value).over(block.orderBy(*[F.desc(c) for c in order])),
        }

    def joined(w: WindowSpec) -> dict[str, Column]:
        head, tail = F.col("_head"), F.lag("_tail", n - 1).over(w)
        tail = F.when(F.col("_n") % n != 0, tail)  # else the frame is this block
        return {out: F.coalesce(tail + head, head, tail)}

    return o.bounded(joined, before=n - 1, prepare=within_blocks)


def moving_average_ring(
    df: DataFrame, value: str, key: Names, order_by: Names, capacity: int, out: str = "moving_avg", limit: int | None = None
) -> DataFrame:
    """Ring-buffer average: 0.0 for the first ``capacity - 2`` rows, then the sum of the
    last ``capacity`` rows over ``capacity``, a missing row counting as 0."""
    o = _moving_sum(Ordered.of(df, key, order_by, limit), value, capacity, out)
    full = F.col("_n") >= max(1, capacity - 1)
    return o.df.withColumn(out, F.when(full, F.col(out) / F.lit(float(capacity))).otherwise(F.lit(0.0))).drop("_n")


def moving_average(
    df: DataFrame, value: str, key: Names, order_by: Names, n: int, out: str = "moving_avg", limit: int | None = None
) -> DataFrame:
    """Simple moving average: 0.0 until ``n`` rows are there, then their mean."""
    o = _moving_sum(Ordered.of(df, key, order_by, limit), value, n, out)
    return o.df.withColumn(
        out, F.when(F.col("_n") >= n, F.col(out) / F.lit(float(n))).otherwise(F.lit(0.0))
    ).drop("_n")


def rounded_moving_average(
    df: DataFrame,
    value: str,
    key: Names,
    order_by: Names,
    n: int = 6,
    digits: int = 1,
    out: str = "moving_avg",
    limit: int | None = None,
) -> DataFrame:
    """Mean of each full window of ``n`` rows, rounded half-even. Decimal arithmetic, so
    that a tie is a tie."""
    exact = F.col(value).cast("decimal(18,4)")
    o = (
        Ordered.of(df, key, order_by, limit)
        .bounded(lambda w: {out: F.avg(exact).over(w.rowsBetween(-(n - 1), 0))}, before=n - 1)
        .position("_n")
    )
    return o.where(F.col("_n") >= n).withColumn(out, F.bround(out, digits).cast("double")).drop("_n")


def trailing_difference(
    df: DataFrame, value: str, key: Names, order_by: Names, n: int, out: str = "diff", limit: int | None = None
) -> DataFrame:
    """0 for the first ``n`` rows, then the value minus the one ``n`` rows before."""
    o = Ordered.of(df, key, order_by, limit)
    return o.bounded(lambda w: {out: F.coalesce(F.col(value) - F.lag(value, n).over(w), F.lit(0))}, before=n).df


def leading_difference(
    df: DataFrame, value: str, key: Names, order_by: Names, n: int, out: str = "diff", limit: int | None = None
) -> DataFrame:
    """The value minus the one ``n`` rows later; the last ``n`` rows are dropped."""
    o = Ordered.of(df, key, order_by, limit).bounded(
        lambda w: {out: F.col(value) - F.lead(value, n).over(w), "_has": F.lead(F.lit(True), n).over(w)}, after=n
    )
    return o.where(F.col("_has")).drop("_has")


def delay_line(
    df: DataFrame,
    x: str,
    y: str,
    key: Names,
    order_by: Names,
    delay: int,
    scale: float,
    limit: int | None = None,
) -> DataFrame:
    """Adds ``x_delayed`` (``x`` of ``delay`` rows ago, else 0) and ``y_mixed`` (``y`` plus
    ``scale`` times that)."""
    o = Ordered.of(df, key, order_by, limit).bounded(
        lambda w: {"x_delayed": F.lag(F.col(x).cast("double"), delay, 0.0).over(w)}, before=delay
    )
    return o.df.withColumn("y_mixed", F.col(y) + F.lit(scale) * F.col("x_delayed"))


def running_count_and_sum(
    df: DataFrame, value: str, key: Names, order_by: Names, limit: int | None = None
) -> DataFrame:
    """Adds ``running_count`` and ``running_sum``."""
    o = Ordered.of(df, key, order_by, limit)
    return o.running({"running_count": ("count", F.lit(1)), "running_sum": ("sum", value)}).df


def running_window_totals(
    df: DataFrame, ts: str, duration: str, key: Names = (), limit: int | None = None
) -> DataFrame:
    """Count per tumbling window and the total of all windows so far. Counted first, so
    only one row per window is ordered."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = (
        df.groupBy(*keys, F.window(ts, duration).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("w.start").alias("window_start"), "n")
    )
    return Ordered.of(counts, keys, "window_start", limit).running({"total": ("sum", "n")}).df


def progress_window(
    counts: DataFrame, value: str, key: Names, order_by: Names, n: int, limit: int | None = None
) -> DataFrame:
    """Running sum inside groups of ``n`` buckets that starts anew with each group.

    Buckets are numbered from 1 and a group is ``number div n``, so the first group has
    ``n - 1`` buckets. Adds ``bucket_no``, ``iter`` (``number mod n``) and ``progress``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    numbered = Ordered.of(counts, keys, order, limit).position("bucket_no").df
    grouped = numbered.withColumn("_group", F.expr(f"bucket_no div {n}"))
    # at most n rows per group
    o = Ordered.of(grouped, [*keys, "_group"], order, limit, bounded_groups=True)
    return o.running({"progress": ("sum", value)}).df.withColumn("iter", F.expr(f"bucket_no % {n}")).drop("_group")


def number_rows(
    df: DataFrame, order_by: Names, key: Names = (), out: str = "n", start: int = 1, limit: int | None = None
) -> DataFrame:
    """Number rows from ``start``; also stamps commands with their sequence number."""
    numbered = Ordered.of(df, key, order_by, limit).position(out).df
    return numbered if start == 1 else numbered.withColumn(out, F.col(out) + F.lit(start - 1))


def last_n(
    df: DataFrame, value: str, key: Names, order_by: Names, n: int, out: str = "last_values", limit: int | None = None
) -> DataFrame:
    """The last up to ``n`` values, this row's included, as a list."""
    o = Ordered.of(df, key, order_by, limit)
    return o.bounded(lambda w: {out: F.collect_list(value).over(w.rowsBetween(-(n - 1), 0))}, before=n - 1).df


def sliding_lists(
    df: DataFrame, value: str, key: Names, order_by: Names, n: int, out: str = "window_values", limit: int | None = None
) -> DataFrame:
    """One list of exactly ``n`` values per full window; a group shorter than ``n`` gives
    its one short list."""
    o = (
        Ordered.of(df, key, order_by, limit)
        .bounded(
            lambda w: {
                out: F.collect_list(value).over(w.rowsBetween(-(n - 1), 0)),
                "_more": F.lead(F.lit(True), 1).over(w),
            },
            before=n - 1,
            after=1,
        )
        .position("_n")
    )
    return o.where((F.col("_n") >= n) | F.col("_more").isNull()).drop("_n", "_more")


def monotonic(
    df: DataFrame, value: str, key: Names, order_by: Names, start: float = 0, limit: int | None = None
) -> DataFrame:
    """Rows whose value is above ``start`` and above every earlier value."""
    o = Ordered.of(df, key, order_by, limit).running({"_high": ("max", value)}, exclusive=True)
    return o.where(F.col(value) > F.greatest(F.col("_high"), F.lit(start))).drop("_high")


def running_histogram(
    df: DataFrame, category: str, order_by: Names, out: str = "count_so_far", limit: int | None = None
) -> DataFrame:
    """After each row: how often its category was seen so far."""
    return Ordered.of(df, category, order_by, limit).position(out).df


def fill_forward(
    df: DataFrame, value: str | Column, key: Names, order_by: Names, out: str = "filled", limit: int | None = None
) -> DataFrame:
    """The last known (non-null) value."""
    return Ordered.of(df, key, order_by, limit).running({out: ("last", value)}).df

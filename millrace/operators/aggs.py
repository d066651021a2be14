"""Aggregations, bounded lists, percentiles, limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.ordered import Ordered

Names = str | Sequence[str]


def _names(x: Names) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def count_rows(df: DataFrame, key: Names = (), out: str = "n") -> DataFrame:
    return df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias(out))


def sum_of(df: DataFrame, value: str, key: Names = (), out: str = "total") -> DataFrame:
    return df.groupBy(*_names(key)).agg(F.sum(value).alias(out))


def sum_every(df: DataFrame, value: str, n: int, order_by: Names, key: Names = (), limit: int | None = None) -> DataFrame:
    """Sum of every ``n`` rows in order; the last chunk may be short."""
    keys = _names(key)
    needed = df.select(*dict.fromkeys([*keys, *_names(order_by), value]))
    rows = Ordered.of(needed, keys, order_by, limit).position("_n").df
    return rows.groupBy(*keys, F.expr(f"(_n - 1) div {n}").alias("chunk")).agg(F.sum(value).alias("total"))


def mean_parts(df: DataFrame, value: str, key: Names = ()) -> DataFrame:
    """Average kept as numerator and denominator, so that partial results can be merged."""
    return df.groupBy(*_names(key)).agg(F.sum(value).alias("numerator"), F.count(value).alias("denominator"))


def merge_means(parts: DataFrame, key: Names = ()) -> DataFrame:
    """Averages from any number of partial results."""
    summed = parts.groupBy(*_names(key)).agg(
        F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")
    )
    return summed.withColumn("average", F.try_divide(F.col("numerator"), F.col("denominator")))


def max_and_min(df: DataFrame, value: str, key: Names = ()) -> DataFrame:
    return df.groupBy(*_names(key)).agg(F.max(value).alias("max"), F.min(value).alias("min"))


def product_of(df: DataFrame, value: Column | str, key: Names = (), out: str = "product") -> DataFrame:
    return df.groupBy(*_names(key)).agg(F.product(value).alias(out))


def first_and_last(df: DataFrame, value: str, order_by: Names, key: Names = ()) -> DataFrame:
    """First and last non-null value in order."""
    at = F.when(F.col(value).isNotNull(), F.struct(*_names(order_by)))
    return df.groupBy(*_names(key)).agg(
        F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last")
    )


def all_and_any(df: DataFrame, condition: Column, key: Names = ()) -> DataFrame:
    """``all_true`` (true for no rows) and ``any_true`` (false for no rows)."""
    return df.groupBy(*_names(key)).agg(
        F.coalesce(F.bool_and(condition), F.lit(True)).alias("all_true"),
        F.coalesce(F.bool_or(condition), F.lit(False)).alias("any_true"),
    )


def count_sum_mean(df: DataFrame, value: str, key: Names = ()) -> DataFrame:
    """Count, sum and mean in one pass; for no values these are 0, 0.0 and 0.0."""
    return df.groupBy(*_names(key)).agg(
        F.count(value).alias("n"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
    )


def histogram(df: DataFrame, category: str, out: str = "n") -> DataFrame:
    """Rows per category, most frequent first, then by name."""
    return df.groupBy(category).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), category)


def validated_sum(df: DataFrame, value: str, error: Column, key: Names = ()) -> DataFrame:
    """Sum if every row passes, else null and the number of errors. ``error`` is the
    failure text of a row or null; the texts themselves are ``failures``."""
    failed = F.count_if(error.isNotNull())
    return df.groupBy(*_names(key)).agg(
        F.when(failed == 0, F.sum(value)).alias("total"), failed.alias("n_errors")
    )


def failures(df: DataFrame, error: Column, column: str = "error") -> DataFrame:
    """Every failing row with its text: the error list, one row per error."""
    return df.withColumn(column, error).where(F.col(column).isNotNull())


def validated_rows(df: DataFrame, error: Column, key: Names, column: str = "error") -> DataFrame:
    """Per key all rows if all pass, else only its errors: rows of failing keys that
    pass themselves are left out."""
    keys = _names(key)
    checked = df.withColumn(column, error)
    bad = checked.where(F.col(column).isNotNull()).select(*keys).distinct()
    good = checked.where(F.col(column).isNull()).join(bad, keys, "left_anti")
    return good.unionByName(checked.where(F.col(column).isNotNull()))


def ordered_lists(
    df: DataFrame,
    value: Column | str,
    key: Names,
    order_by: Names,
    max_items: int | None = None,
    out: str = "items",
    limit: int | None = None,
) -> DataFrame:
    """Values of a group in order, as one list. With ``max_items`` the list is cut into rows of
    as many values, numbered by ``piece``, so that no row grows with its group."""
    keys = _names(key)
    item = F.col(value) if isinstance(value, str) else value
    if max_items is None:
        order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(_names(order_by))]
        whole = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, item.alias("_v")))).alias("_l"))
        return whole.select(*keys, F.col("_l._v").alias(out))
    numbered = Ordered.of(df, keys, order_by, limit).position("_n").df
    return (
        numbered.withColumn("piece", F.expr(f"(_n - 1) div {max_items}"))
        .groupBy(*keys, "piece")
        .agg(F.array_sort(F.collect_list(F.struct("_n", item.alias("v")))).alias("_l"))
        .select(*keys, "piece", F.col("_l.v").alias(out))
    )


def concat_text(
    df: DataFrame, text: str, key: Names, order_by: Names, out: str = "text", limit: int | None = None
) -> DataFrame:
    """Fragments of a group joined in order, as one text. Runs of fragments are joined first, so
    that the fragments of a large group meet in parts; a null fragment is empty."""
    keys = _names(key)
    parts = ordered_lists(df, F.coalesce(F.col(text), F.lit("")), keys, order_by, 1000, "_parts", limit)
    pieces = parts.select(*keys, "piece", F.array_join("_parts", "").alias("_text"))
    return ordered_lists(pieces, "_text", keys, "piece", out="_parts").select(*keys, F.array_join("_parts", "").alias(out))


def percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], key: Names = (), limit: int | None = None
) -> DataFrame:
    """Exact percentiles: the smallest value with at least that share of rows at or below it.

    Works on counts per distinct value, so equal values collapse before the shuffle and
    a hot key is ranked in parts.
    """
    keys = _names(key)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = Ordered.of(counts, keys, value, limit).running({"_upto": ("sum", "_n")})
    rows = ranked.total({"_total": ("sum", "_n")}).df

    def sought(p: Column) -> Column:
        # the rank sought, in whole rows; rounded first, as 0.9 * 10 is not 9 in doubles
        rank = F.greatest(F.lit(1), F.ceil(F.round(p * F.col("_total"), 6)))
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)

    # Only the few values that hold a rank make rows.
    found = F.filter(F.array(*[F.lit(float(x)) for x in probabilities]), sought)
    return rows.select(*keys, F.explode(found).alias("p"), F.col(value).alias("value"))


def percentiles_approx(
    df: DataFrame, value: str, probabilities: Sequence[float], key: Names = (), accuracy: int = 10_000
) -> DataFrame:
    """The same from a mergeable sketch of fixed size, in one pass."""
    return df.groupBy(*_names(key)).agg(
        F.percentile_approx(value, list(map(float, probabilities)), accuracy).alias("values")
    )


def log_linear_histogram(df: DataFrame, value: str, key: Names = (), bits: int = 7) -> DataFrame:
    """Counts of whole numbers in buckets ``[lo, hi)`` whose width is at most 2^-``bits`` of their
    size (numbers below 2^``bits`` have buckets of their own; negative ones mirror positive ones).

    Buckets do not depend on the data, so histograms of parts, days or streams add up, and a group
    has at most about 64 * 2^``bits`` of each sign. Null values are left out."""
    size = F.abs(F.col(value).cast("long"))
    # The number of binary digits beyond those that a bucket keeps.
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - F.lit(bits + 1)).cast("int")
    width = F.expr("shiftleft(1L, _shift)")
    low = F.expr("shiftleft(shiftright(_size, _shift), _shift)")
    negative = F.col(value) < 0
    placed = df.where(F.col(value).isNotNull()).withColumns({"_size": size, "_shift": shift}).select(
        *_names(key), F.when(negative, -low - width + 1).otherwise(low).alias("lo"), F.when(negative, -low + 1).otherwise(low + width).alias("hi")
    )
    return placed.groupBy(*_names(key), "lo", "hi").agg(F.count(F.lit(1)).alias("n"))


def profile(histogram: DataFrame, probabilities: Sequence[float], key: Names = ()) -> DataFrame:
    """Percentiles from a histogram alone: the bucket that holds each one, so the value is known
    to the relative width of a bucket. Histograms may come in parts."""
    keys = _names(key)
    merged = histogram.groupBy(*keys, "lo", "hi").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys).orderBy("lo")
    # A group has a bounded number of buckets, whatever its rows.
    ranked = merged.withColumns({"_upto": F.sum("n").over(by), "_total": F.sum("n").over(Window.partitionBy(*keys))})

    def sought(p: Column) -> Column:
        rank = F.greatest(F.lit(1), F.ceil(F.round(p * F.col("_total"), 6)))
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("n") < rank)

    found = F.filter(F.array(*[F.lit(float(x)) for x in probabilities]), sought)
    return ranked.select(*keys, F.explode(found).alias("p"), "lo", "hi")


def sort_groups(counts: DataFrame, by: str = "n") -> DataFrame:
    return counts.orderBy(F.desc(by))


# spark.sql.optimizer.windowGroupLimitThreshold, as it is by default.
GROUP_LIMIT = 1000


def retain(
    df: DataFrame, n: int, key: Names, order_by: Names, keep: str = "oldest"
) -> DataFrame:
    """At most ``n`` rows per key (put a window column into the key for a bound per
    window): the oldest, the newest, or ``keep='fail'``.

    The row-number filter is a top-n that Spark applies before the shuffle too, so a hot
    group sends ``n`` rows per task. Spark does so up to ``GROUP_LIMIT`` rows; beyond, large
    groups are numbered in segments.
    """
    keys = _names(key)
    if keep == "fail":
        full = count_rows(df, keys, "_n").where(F.col("_n") > n)
        if not full.isEmpty():
            raise ValueError(f"more than {n} rows in a group")
        return df
    order = [F.col(c).asc() if keep == "oldest" else F.col(c).desc() for c in _names(order_by)]
    if keep not in ("oldest", "newest"):
        raise ValueError(f"keep is 'oldest', 'newest' or 'fail', not {keep!r}")
    if n > GROUP_LIMIT:
        o = Ordered.of(df, keys, order_by).position("_rank")
        if keep == "oldest":
            return o.where(F.col("_rank") <= n).drop("_rank")
        o = o.total({"_total": ("count", F.lit(1))})
        return o.where(F.col("_rank") > F.col("_total") - n).drop("_rank", "_total")
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def last_per_tick(
    df: DataFrame, value: str, ts: str, unique: str, tick: str, n: int, key: Names = (), out: str = "values"
) -> DataFrame:
    """The last up to ``n`` values of each tick, in order."""
    keys = _names(key)
    windowed = df.withColumn("tick", F.window(ts, tick).start)
    return (
        retain(windowed, n, [*keys, "tick"], [ts, unique], "newest")
        .groupBy(*keys, "tick")
        .agg(F.array_sort(F.collect_list(F.struct(ts, unique, F.col(value).alias("_v")))).alias("_l"))
        .select(*keys, "tick", F.col("_l._v").alias(out))
    )

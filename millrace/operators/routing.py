"""Routing rows to channels: round robin, key hash, hash ring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.ordered import Jump, Ordered

Names = str | Sequence[str]


def round_robin(df: DataFrame, n: int, order_by: Names, out: str = "channel", limit: int | None = None) -> DataFrame:
    """Rows dealt to ``n`` channels in turn, in order, from channel 0."""
    numbered = Ordered.of(df, [], order_by, limit).position(out).df
    return numbered.withColumn(out, ((F.col(out) - 1) % n).cast("int"))


def shard(value: Column, n: int) -> Column:
    """Shard number of a whole number: its remainder, never negative."""
    return F.pmod(value, F.lit(n)).cast("int")


def hash_shard(n: int, *columns: str) -> Column:
    """Shard number from the hash of any columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def by_hash(df: DataFrame, n: int, *columns: str, out: str = "channel") -> DataFrame:
    """All rows of a key to the same channel, and to the same partition. The channel is a
    row-local column; repartition by it only where work per channel follows."""
    return df.withColumn(out, hash_shard(n, *columns))


def balance(df: DataFrame, n: int) -> DataFrame:
    """Spread over ``n`` tasks evenly, whatever the keys; free executors take the next."""
    return df.repartition(n)


def balance_and_merge(df: DataFrame, n: int, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Work spread over ``n`` tasks; the merged result is one table."""
    return balance(df, n).transform(work)


def in_sequence(
    df: DataFrame,
    key: Names,
    order_by: Names,
    inputs: Sequence[str],
    init: tuple,
    step: Callable,
    outputs: Sequence[tuple[str, T.DataType]],
    jump: Jump | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows of one key one after the other, different keys in parallel."""
    return Ordered.of(df, key, order_by, limit).fold(inputs, init, step, outputs, jump)


# -- hash ring ------------------------------------------------------------------

RING_BITS = 32
BUCKET_BITS = 12


def ring_hash(text: Column) -> Column:
    """A position on the ring of 2^32 points."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_ring(df: DataFrame, nodes: Sequence[str], replicas: int = 10) -> DataFrame:
    """The ring as intervals ``(bucket, lo, hi, node)``: positions in ``(lo, hi]`` belong
    to the node at ``hi``. Cut at bucket borders, so that a lookup is an equi-join."""
    spark = df.sparkSession
    names = spark.createDataFrame([(n,) for n in nodes], "node string")
    points = names.select("node", F.explode(F.sequence(F.lit(1), F.lit(replicas))).alias("r")).select(
        "node", ring_hash(F.concat_ws(":", "node", "r")).alias("hi")
    )
    # one row per configured point: a single window partition is right here
    w = Window.orderBy("hi", "node")
    inner = points.select("node", "hi", F.lag("hi", 1, -1).over(w).alias("lo"))
    end = points.agg(F.min_by("node", F.struct("hi", "node")).alias("node"), F.max("hi").alias("lo"))
    wrapped = end.select("node", F.lit((1 << RING_BITS) - 1).alias("hi"), "lo")
    intervals = inner.unionByName(wrapped).where("hi > lo")
    first, last = F.shiftright(F.col("lo") + 1, RING_BITS - BUCKET_BITS), F.shiftright("hi", RING_BITS - BUCKET_BITS)
    return intervals.select(F.explode(F.sequence(first, last)).alias("_bucket"), "lo", "hi", "node")


def consistent_hash(df: DataFrame, key: str, nodes: Sequence[str], replicas: int = 10, out: str = "node") -> DataFrame:
    """Each row to the node at the next ring point after its key's hash.

    The ring has at most ``len(nodes) * replicas + 2^12`` rows, which bounds the broadcast.
    """
    ring = hash_ring(df, nodes, replicas).withColumnRenamed("node", out)
    placed = df.withColumn("_h", ring_hash(F.col(key).cast("string"))).withColumn(
        "_bucket", F.shiftright("_h", RING_BITS - BUCKET_BITS)
    )
    inside = (F.col("_h") > F.col("lo")) & (F.col("_h") <= F.col("hi"))
    ring = ring.withColumnRenamed("_bucket", "_b")
    joined = placed.join(F.broadcast(ring), (F.col("_bucket") == F.col("_b")) & inside)
    return joined.select(*df.columns, out)


def moved_keys(df: DataFrame, key: str, before: Sequence[str], after: Sequence[str], replicas: int = 10) -> DataFrame:
    """How many distinct keys change their node when the set of nodes changes."""
    keys = df.select(key).distinct()
    both = consistent_hash(keys, key, before, replicas, "was").transform(
        lambda d: consistent_hash(d, key, after, replicas, "now")
    )
    return both.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("was") != F.col("now")).alias("n_moved"))

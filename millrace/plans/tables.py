"""Queries for joins (J), merges (U), aggregates (A) and retention (L)."""

from pyspark.sql import functions as F

from millrace.operators import aggs, joins, merge, timewindows
from millrace.plans.registry import joined, micros, query, table

ORDER = ["ts", "event_id"]


def _typed(spark, sf, kind, *columns):
    """The events of one type as a stream of its own."""
    return table(spark, sf, "events").where(F.col("event_type") == kind).select("event_id", "ts", "user_id", *columns)


# -- joins --------------------------------------------------------------------


@query(
    "j01_merge_join_pairwise",
    """
    SELECT a.user_id, a.event_id AS click_id, b.event_id AS view_id
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'click') a
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'view') b
      ON a.user_id = b.user_id AND a.n = b.n
    """,
)
def _(spark, sf):
    clicks = _typed(spark, sf, "click").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("cts"))
    views = _typed(spark, sf, "view").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("vts"))
    df = joins.merge_join(clicks, views, "user_id", ["cts", "click_id"], ["vts", "view_id"])
    return df.select("user_id", "click_id", "view_id")


@query(
    "j01_merge_join_relational",
    """
    SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
    """,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return joins.merge_join(orders, lines, "o_orderkey", "o_orderkey", "l_linenumber", mode="relational")


@query(
    "j02_zip",
    """
    SELECT a.n AS idx, a.event_id AS click_id, b.event_id AS view_id, c.event_id AS purchase_id
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'click') a
    JOIN (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'view') b ON a.n = b.n
    JOIN (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase') c ON a.n = c.n
    """,
)
def _(spark, sf):
    sides = []
    for kind in ("click", "view", "purchase"):
        df = _typed(spark, sf, kind).select(F.col("event_id").alias(f"{kind}_id"), F.col("ts").alias(f"{kind}_ts"))
        sides.append((df, [f"{kind}_ts", f"{kind}_id"]))
    return joins.zip_rows(sides).select("idx", "click_id", "view_id", "purchase_id")


@query(
    "j03_latest_per_tick",
    """
    SELECT epoch_us(date_trunc('hour', ts)) AS tick,
           max_by(value, (ts, event_id)) FILTER (event_type = 'click') AS click,
           max_by(value, (ts, event_id)) FILTER (event_type = 'view') AS view,
           max_by(value, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase
    FROM events GROUP BY 1
    HAVING count(DISTINCT event_type) FILTER (event_type IN ('click', 'view', 'purchase')) = 3
    """,
)
def _(spark, sf):
    sources = {kind: _typed(spark, sf, kind, "value") for kind in ("click", "view", "purchase")}
    df = joins.latest_per_tick(sources, "ts", "value", "event_id", "1 hour")
    return df.withColumn("tick", micros("tick"))


@query(
    "j03_earliest_per_tick",
    """
    SELECT user_id, epoch_us(date_trunc('day', ts)) AS tick,
           min_by(value, (ts, event_id)) FILTER (event_type = 'click') AS click,
           min_by(value, (ts, event_id)) FILTER (event_type = 'view') AS view
    FROM events GROUP BY 1, 2
    HAVING count(DISTINCT event_type) FILTER (event_type IN ('click', 'view')) = 2
    """,
)
def _(spark, sf):
    sources = {kind: _typed(spark, sf, kind, "value") for kind in ("click", "view")}
    df = joins.latest_per_tick(sources, "ts", "value", "event_id", "1 day", "user_id", pick="earliest")
    return df.withColumn("tick", micros("tick"))


@query(
    "j04_asof",
    """
    SELECT f.event_id, f.user_id, s.value AS slow_value
    FROM (SELECT * FROM events WHERE event_type = 'click') f
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
      ON f.user_id = s.user_id AND f.ts >= s.ts
    """,
)
def _(spark, sf):
    df = joins.asof(_typed(spark, sf, "click"), _typed(spark, sf, "signup", "value"), "ts", "event_id", ["value"], "user_id")
    return df.drop("ts")


@query(
    "j05_sums_per_tick",
    """
    SELECT * FROM (
      SELECT epoch_us(date_trunc('hour', ts)) AS tick,
             round(sum(value) FILTER (event_type = 'click'), 2) AS left_sum,
             round(sum(value) FILTER (event_type = 'view'), 2) AS right_sum
      FROM events GROUP BY 1)
    WHERE left_sum IS NOT NULL AND right_sum IS NOT NULL
    """,
)
def _(spark, sf):
    df = joins.sums_per_tick(_typed(spark, sf, "click", "value"), _typed(spark, sf, "view", "value"), "ts", "value", "1 hour")
    return df.select(micros("tick").alias("tick"), F.round("left_sum", 2).alias("left_sum"), F.round("right_sum", 2).alias("right_sum"))


@query(
    "j06_enrich_with_flag",
    """
    SELECT o_orderkey, o_custkey, c_mktsegment, c_custkey IS NOT NULL AS known
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    known = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.enrich(orders, known, "o_custkey")


@query(
    "j08_in_set",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.in_set(lines, "l_partkey", table(spark, sf, "part").where("p_size <= 5").select("p_partkey"))


@query(
    "j08_not_in_set",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.not_in_set(customers, "c_custkey", table(spark, sf, "orders").where("o_totalprice > 300000").select("o_custkey"))


@query(
    "j08_membership_flag",
    "SELECT s_suppkey, s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AS in_region FROM supplier",
)
def _(spark, sf):
    members = table(spark, sf, "nation").where("n_regionkey = 1").select("n_nationkey")
    df = joins.flag_member(table(spark, sf, "supplier"), "s_nationkey", members, "in_region")
    return df.select("s_suppkey", "in_region")


@query(
    "j09_merge_and_dedup",
    """
    WITH l AS (SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS rn, 0 AS side FROM events WHERE event_type = 'click'),
         r AS (SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS rn, 1 AS side FROM events WHERE event_type = 'view'),
         m AS (SELECT *, row_number() OVER (ORDER BY rn, side) AS merged_no FROM (SELECT * FROM l UNION ALL SELECT * FROM r)),
         p AS (SELECT *, lag(merged_no) OVER (PARTITION BY user_id ORDER BY merged_no) AS prev FROM m)
    SELECT merged_no, event_id, user_id FROM p WHERE prev IS NULL OR merged_no - prev >= 20
    """,
)
def _(spark, sf):
    left, right = _typed(spark, sf, "click"), _typed(spark, sf, "view")
    return merge.dedup_merge(left, right, "user_id", ORDER, ORDER, 20).select("merged_no", "event_id", "user_id")


@query(
    "j10_combine_results",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal >= 0 AND o.value IS NOT NULL AND o.value < 2000000 THEN c_acctbal END AS balance,
           CASE WHEN c_acctbal >= 0 AND o.value IS NOT NULL AND o.value < 2000000 THEN round(o.value, 2) END AS spent,
           concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'negative balance' END,
                           CASE WHEN o.value >= 2000000 THEN 'spent too much' END) AS errors
    FROM customer JOIN (SELECT o_custkey, sum(o_totalprice) AS value FROM orders GROUP BY 1) o ON o_custkey = c_custkey
    """,
)
def _(spark, sf):
    def errors(bad, text):
        return F.when(bad, F.array(F.lit(text))).otherwise(F.array().cast("array<string>")).alias("errors")

    balance = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("value"), errors(F.col("c_acctbal") < 0, "negative balance")
    )
    spent = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("o_totalprice").alias("value"))
        .withColumn("errors", errors(F.col("value") >= 2000000, "spent too much"))
    )
    df = joins.combine_results({"balance": balance, "spent": spent}, "c_custkey")
    return df.select("c_custkey", "balance", F.round("spent", 2).alias("spent"), joined("errors", "; ").alias("errors"))


# -- merges -------------------------------------------------------------------


@query(
    "u01_merge",
    "SELECT event_id, user_id FROM events WHERE event_type IN ('click', 'view', 'purchase')",
)
def _(spark, sf):
    return merge.merge(*[_typed(spark, sf, k).drop("ts") for k in ("click", "view", "purchase")])


@query(
    "u02_merge_sorted",
    """
    SELECT row_number() OVER (ORDER BY user_id, event_type DESC, event_id) AS merged_no, event_id, user_id
    FROM events WHERE event_type IN ('click', 'view')
    """,
)
def _(spark, sf):
    # right ('view') goes first among equal users
    left, right = (_typed(spark, sf, k).drop("ts") for k in ("click", "view"))
    return merge.merge_sorted(left, right, ["user_id", "event_id"])


@query(
    "u03_interleave",
    """
    SELECT row_number() OVER (ORDER BY rn, event_type) AS merged_no, event_id
    FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
          FROM events WHERE event_type IN ('click', 'view'))
    """,
)
def _(spark, sf):
    left, right = (_typed(spark, sf, k).drop("user_id") for k in ("click", "view"))
    return merge.interleave(left, right, ORDER, ORDER).select("merged_no", "event_id")


@query(
    "u04_heartbeats",
    """
    WITH t AS (SELECT event_id, epoch_us(ts) AS tick_us, epoch_us(ts) // 60000000 AS m FROM events)
    SELECT event_id, tick_us, false AS is_heartbeat FROM t
    UNION ALL
    SELECT NULL, m * 60000000, true FROM (SELECT unnest(range((SELECT min(m) FROM t), (SELECT max(m) + 1 FROM t))) AS m)
    WHERE m NOT IN (SELECT m FROM t)
    """,
)
def _(spark, sf):
    df = merge.heartbeats(table(spark, sf, "events").select("event_id", "ts"), "ts", 60)
    return df.select("event_id", micros("ts").alias("tick_us"), "is_heartbeat")


@query(
    "u05_distinct_first",
    """
    SELECT event_id, user_id, event_type
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return merge.distinct_first(df, ["user_id", "event_type"], ORDER).drop("ts")


@query(
    "u06_distinct_in_last_n",
    """
    WITH p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events)
    SELECT event_id, user_id
    FROM (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY n) AS prev FROM p) WHERE prev IS NULL OR n - prev >= 50
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return merge.distinct_in_last(df, "user_id", ORDER, 50).drop("ts")


@query(
    "u07_flag_duplicates",
    """
    SELECT event_id, user_id, seq, consumer, seq <= greatest(start, coalesce(high, start)) AS is_duplicate,
           greatest(start, coalesce(high, start), seq) AS version
    FROM (SELECT *, max(seq) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
          FROM (SELECT event_id, user_id, ts, CAST(floor(value) AS BIGINT) AS seq FROM events)),
         (VALUES ('a', CAST(0 AS BIGINT)), ('b', 100)) AS c(consumer, start)
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "user_id", F.floor("value").alias("seq"))
    return merge.flag_duplicates(df, "seq", ORDER, {"a": 0, "b": 100}, "user_id").drop("ts")


# -- aggregates ---------------------------------------------------------------


@query("a01_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return aggs.count_rows(table(spark, sf, "events"), "event_type")


@query("a02_sum", "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("long").alias("q"))
    return aggs.sum_of(df, "q", ["l_returnflag", "l_linestatus"])


@query(
    "a03_sum_every_n",
    """
    SELECT (n - 1) // 10 AS chunk, round(sum(value), 2) AS total
    FROM (SELECT value, row_number() OVER (ORDER BY ts, event_id) AS n FROM events) GROUP BY 1
    """,
)
def _(spark, sf):
    df = aggs.sum_every(table(spark, sf, "events"), "value", 10, ORDER)
    return df.withColumn("total", F.round("total", 2))


@query(
    "a04_average_from_parts",
    """
    SELECT l_returnflag, round(sum(l_quantity), 2) AS numerator, count(l_quantity) AS denominator, round(avg(l_quantity), 6) AS average
    FROM lineitem GROUP BY 1
    """,
)
def _(spark, sf):
    parts = aggs.mean_parts(table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag", "l_linestatus"])
    df = aggs.merge_means(parts, "l_returnflag")
    return df.withColumns({"numerator": F.round("numerator", 2), "average": F.round("average", 6)})


@query("a05_max_and_min", "SELECT l_shipdate IS NULL AS no_date, l_linestatus, max(l_extendedprice) AS max, min(l_extendedprice) AS min FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("no_date", F.col("l_shipdate").isNull())
    return aggs.max_and_min(df, "l_extendedprice", ["no_date", "l_linestatus"])


@query("a06_product", "SELECT user_id, round(product(1 + value / 10000), 6) AS product FROM events GROUP BY 1")
def _(spark, sf):
    df = aggs.product_of(table(spark, sf, "events"), 1 + F.col("value") / 10000, "user_id")
    return df.withColumn("product", F.round("product", 6))


@query(
    "a07_first_and_last",
    """
    SELECT user_id, arg_min(value, (ts, event_id)) FILTER (event_type = 'purchase') AS first,
           arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS last
    FROM events GROUP BY 1
    """,
)
def _(spark, sf):
    paid = F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid")
    return aggs.first_and_last(table(spark, sf, "events").select("user_id", "ts", "event_id", paid), "paid", ORDER, "user_id")


@query(
    "a08_all_and_any",
    "SELECT user_id, bool_and(value > 1) AS all_true, bool_or(value > 300) AS any_true FROM events GROUP BY 1",
)
def _(spark, sf):
    df = table(spark, sf, "events")
    all_ = aggs.all_and_any(df, F.col("value") > 1, "user_id").select("user_id", "all_true")
    any_ = aggs.all_and_any(df, F.col("value") > 300, "user_id").select("user_id", "any_true")
    return all_.join(any_, "user_id")


@query(
    "a09_count_sum_mean",
    """
    SELECT user_id, count(v) AS n, round(coalesce(sum(v), 0), 2) AS total, round(coalesce(avg(v), 0), 6) AS mean
    FROM (SELECT user_id, CASE WHEN value > 250 THEN value END AS v FROM events) GROUP BY 1
    """,
)
def _(spark, sf):
    v = F.when(F.col("value") > 250, F.col("value")).alias("v")
    df = aggs.count_sum_mean(table(spark, sf, "events").select("user_id", v), "v", "user_id")
    return df.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6)})


@query("a10_histogram", "SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_type")
def _(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return aggs.histogram(joins.lookup(table(spark, sf, "lineitem").select("l_partkey"), parts, "l_partkey", "inner"), "p_type")


_ODD = "CASE WHEN o_custkey % 7 = 3 AND o_totalprice > 400000 THEN concat('order ', o_orderkey, ' is too large') END"


@query(
    "a11_validated_sum",
    f"""
    SELECT o_custkey, CASE WHEN count(e) = 0 THEN round(sum(o_totalprice), 2) END AS total, count(e) AS n_errors
    FROM (SELECT *, {_ODD} AS e FROM orders) GROUP BY 1
    """,
)
def _(spark, sf):
    df = aggs.validated_sum(table(spark, sf, "orders"), "o_totalprice", F.expr(_ODD), "o_custkey")
    return df.withColumn("total", F.round("total", 2))


@query("a11_failures", f"SELECT * FROM (SELECT o_orderkey, {_ODD} AS error FROM orders) WHERE error IS NOT NULL")
def _(spark, sf):
    return aggs.failures(table(spark, sf, "orders"), F.expr(_ODD)).select("o_orderkey", "error")


@query(
    "a12_validated_rows",
    f"""
    SELECT o_custkey, o_orderkey, e AS error
    FROM (SELECT *, count(e) OVER (PARTITION BY o_custkey) AS n FROM (SELECT *, {_ODD} AS e FROM orders))
    WHERE n = 0 OR e IS NOT NULL
    """,
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return aggs.validated_rows(df, F.expr(_ODD), "o_custkey").drop("o_totalprice")


@query(
    "a13_ordered_window_lists",
    """
    SELECT epoch_us(date_trunc('day', ts)) AS day, string_agg(event_id, ',' ORDER BY ts, event_id) AS ids FROM events GROUP BY 1
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", F.window("ts", "1 day").start.alias("day"))
    lists = aggs.ordered_lists(df, "event_id", "day", ORDER, out="ids")
    return lists.select(micros("day").alias("day"), joined("ids").alias("ids"))


@query(
    "a14_concat_fragments",
    "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY 1",
)
def _(spark, sf):
    return aggs.concat_text(table(spark, sf, "conversations"), "text", "conv_id", "turn")


_BUCKETS = """
    SELECT event_type, v // w * w AS lo, v // w * w + w AS hi, count(*) AS n
    FROM (SELECT *, CAST(pow(2, greatest(0, length(bin(v)) - 8)) AS BIGINT) AS w FROM (SELECT event_type, CAST(floor(value * 1000) AS BIGINT) AS v FROM events))
    GROUP BY ALL
"""


@query("a15_log_linear_histogram", _BUCKETS)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_type", F.floor(F.col("value") * 1000).alias("v"))
    return aggs.log_linear_histogram(df, "v", "event_type")


@query(
    "a15_profile",
    f"""
    SELECT event_type, p, min(lo) AS lo, min(hi) AS hi
    FROM (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY lo) AS upto, sum(n) OVER (PARTITION BY event_type) AS total FROM ({_BUCKETS})),
         (VALUES (0.0::DOUBLE), (0.5), (0.9), (0.99), (1.0)) AS q(p)
    WHERE upto >= greatest(1, ceil(round(p * total, 6))) GROUP BY 1, 2
    """,
)
def _(spark, sf):
    """Percentiles of a table from the histograms of its parts."""
    df = table(spark, sf, "events").select("event_id", "event_type", F.floor(F.col("value") * 1000).alias("v"))
    halves = [aggs.log_linear_histogram(df.where(half), "v", "event_type") for half in ("event_id % 2 = 0", "event_id % 2 <> 0")]
    return aggs.profile(halves[0].unionByName(halves[1]), [0.0, 0.5, 0.9, 0.99, 1.0], "event_type")


@query(
    "a15_percentiles",
    """
    SELECT event_type, p, value
    FROM (SELECT event_type, unnest([0.5, 0.9, 0.99, 0.999]::DOUBLE[]) AS p,
                 unnest(quantile_disc(gap, [0.5, 0.9, 0.99, 0.999])) AS value
          FROM (SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS gap
                FROM events) WHERE gap IS NOT NULL GROUP BY 1)
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "ts").withColumn("at", micros("ts"))
    df = timewindows.gaps(df, "at", "event_type", ORDER)
    return aggs.percentiles(df, "gap", [0.5, 0.9, 0.99, 0.999], "event_type")


@query("a15_percentiles_approx")
def _(spark, sf):
    df = aggs.percentiles_approx(table(spark, sf, "lineitem"), "l_extendedprice", [0.5, 0.9, 0.99], "l_returnflag")
    return df.select("l_returnflag", joined("values").alias("values"))


# -- limits -------------------------------------------------------------------


@query("l01_sort_groups", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC")
def _(spark, sf):
    return aggs.sort_groups(aggs.count_rows(table(spark, sf, "lineitem"), "l_suppkey"))


@query("l03_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def _retain_sql(order: str) -> str:
    return f"""
    SELECT event_id, event_type, epoch_us(h) AS window_start
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type, h ORDER BY ts {order}, event_id {order}) AS rn
          FROM (SELECT *, date_trunc('hour', ts) AS h FROM events)) WHERE rn <= 2
    """


def _windowed(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type", F.window("ts", "1 hour").start.alias("window_start"))


@query("l04_retain_oldest", _retain_sql("ASC"))
def _(spark, sf):
    df = aggs.retain(_windowed(spark, sf), 2, ["event_type", "window_start"], ORDER, "oldest")
    return df.drop("ts").withColumn("window_start", micros("window_start"))


@query("l04_retain_newest", _retain_sql("DESC"))
def _(spark, sf):
    df = aggs.retain(_windowed(spark, sf), 2, ["event_type", "window_start"], ORDER, "newest")
    return df.drop("ts").withColumn("window_start", micros("window_start"))


@query(
    "l05_last_per_tick",
    """
    SELECT epoch_us(h) AS tick, string_agg(event_id, ',' ORDER BY ts, event_id) AS ids
    FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY ts DESC, event_id DESC) AS rn
          FROM (SELECT *, date_trunc('hour', ts) AS h FROM events)) WHERE rn <= 5 GROUP BY 1
    """,
)
def _(spark, sf):
    df = aggs.last_per_tick(table(spark, sf, "events").select("event_id", "ts"), "event_id", "ts", "event_id", "1 hour", 5)
    return df.select(micros("tick").alias("tick"), joined("values").alias("ids"))

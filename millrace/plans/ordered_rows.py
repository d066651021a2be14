"""Queries for the ordered-row functions (W), shaping (P) and limits."""

from pyspark.sql import functions as F

from millrace.operators import shape, windows
from millrace.plans.registry import joined, micros, query, table

ORDER = ["ts", "event_id"]


def _events(spark, sf, *columns):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", *columns)


@query(
    "w01_moving_average_ring",
    """
    SELECT event_id, user_id, round(CASE WHEN rn >= 3 THEN s / 4.0 ELSE 0.0 END, 6) AS moving_avg
    FROM (SELECT event_id, user_id, row_number() OVER w AS rn,
                 sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 3 PRECEDING) AS s
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    """,
)
def _(spark, sf):
    df = windows.moving_average_ring(_events(spark, sf, "value"), "value", "user_id", ORDER, 4)
    return df.select("event_id", "user_id", F.round("moving_avg", 6).alias("moving_avg"))


@query(
    "w02_simple_moving_average",
    """
    SELECT event_id, user_id, round(CASE WHEN rn >= 5 THEN s / 5.0 ELSE 0.0 END, 6) AS moving_avg
    FROM (SELECT event_id, user_id, row_number() OVER w AS rn,
                 sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING) AS s
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    """,
)
def _(spark, sf):
    df = windows.moving_average(_events(spark, sf, "value"), "value", "user_id", ORDER, 5)
    return df.select("event_id", "user_id", F.round("moving_avg", 6).alias("moving_avg"))


@query(
    "w02_moving_average_all_rows",
    """
    SELECT event_id, round(CASE WHEN rn >= 100 THEN s / 100.0 ELSE 0.0 END, 5) AS moving_avg
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
                 sum(value) OVER (ORDER BY ts, event_id ROWS 99 PRECEDING) AS s FROM events)
    """,
)
def _(spark, sf):
    df = windows.moving_average(_events(spark, sf, "value"), "value", [], ORDER, 100)
    return df.select("event_id", F.round("moving_avg", 5).alias("moving_avg"))


@query(
    "w03_rounded_moving_average",
    """
    SELECT event_id, user_id,
           (CASE WHEN cents % 60 < 30 THEN cents // 60 WHEN cents % 60 > 30 THEN cents // 60 + 1
                 ELSE cents // 60 + (cents // 60) % 2 END) / 10.0 AS moving_avg
    FROM (SELECT event_id, user_id, row_number() OVER w AS rn,
                 CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER
                   (PARTITION BY user_id ORDER BY ts, event_id ROWS 5 PRECEDING) AS BIGINT) AS cents
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE rn >= 6
    """,
)
def _(spark, sf):
    df = windows.rounded_moving_average(_events(spark, sf, "value"), "value", "user_id", ORDER)
    return df.select("event_id", "user_id", "moving_avg")


@query(
    "w04_trailing_difference",
    """
    SELECT event_id, user_id,
           round(coalesce(value - lag(value, 5) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0), 2) AS diff
    FROM events
    """,
)
def _(spark, sf):
    df = windows.trailing_difference(_events(spark, sf, "value"), "value", "user_id", ORDER, 5)
    return df.select("event_id", "user_id", F.round("diff", 2).alias("diff"))


@query(
    "w05_leading_difference",
    """
    SELECT event_id, user_id, round(diff, 2) AS diff
    FROM (SELECT event_id, user_id, value - lead(value, 4) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS diff
          FROM events) WHERE diff IS NOT NULL
    """,
)
def _(spark, sf):
    df = windows.leading_difference(_events(spark, sf, "value"), "value", "user_id", ORDER, 4)
    return df.select("event_id", "user_id", F.round("diff", 2).alias("diff"))


@query(
    "w06_delay_line",
    """
    SELECT event_id, user_id, x AS x_delayed, round(value + 0.5 * x, 3) AS y_mixed
    FROM (SELECT event_id, user_id, value,
                 coalesce(lag(value, 5) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS x FROM events)
    """,
)
def _(spark, sf):
    df = windows.delay_line(_events(spark, sf, "value"), "value", "value", "user_id", ORDER, 5, 0.5)
    return df.select("event_id", "user_id", "x_delayed", F.round("y_mixed", 3).alias("y_mixed"))


@query(
    "w07_running_count_and_sum",
    """
    SELECT event_id, user_id, count(*) OVER w AS running_count, round(sum(value) OVER w, 2) AS running_sum
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    """,
)
def _(spark, sf):
    df = windows.running_count_and_sum(_events(spark, sf, "value"), "value", "user_id", ORDER)
    return df.select("event_id", "user_id", "running_count", F.round("running_sum", 2).alias("running_sum"))


@query(
    "w08_running_window_totals",
    """
    SELECT event_type, epoch_us(h) AS window_start, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY h) AS BIGINT) AS total
    FROM (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL)
    """,
)
def _(spark, sf):
    df = windows.running_window_totals(table(spark, sf, "events"), "ts", "1 hour", "event_type")
    return df.withColumn("window_start", micros("window_start"))


@query(
    "w09_progress_window",
    """
    SELECT event_type, epoch_us(d) AS day, n, i AS bucket_no, i % 3 AS iter,
           CAST(sum(n) OVER (PARTITION BY event_type, i // 3 ORDER BY i) AS BIGINT) AS progress
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d) AS i
          FROM (SELECT event_type, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY ALL))
    """,
)
def _(spark, sf):
    counts = (
        table(spark, sf, "events")
        .groupBy("event_type", F.window("ts", "1 day").start.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    df = windows.progress_window(counts, "n", "event_type", "day", 3)
    return df.withColumn("day", micros("day"))


@query("w10_number_elements", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events")
def _(spark, sf):
    return windows.number_rows(_events(spark, sf).drop("user_id"), ORDER).drop("ts")


@query(
    "w11_sequence_stamp",
    """
    SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS seq
    FROM orders
    """,
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.number_rows(df, ["o_orderdate", "o_orderkey"], "o_custkey", "seq", start=0).drop("o_orderdate")


@query(
    "w12_last_n_values",
    """
    SELECT event_id, user_id, array_to_string(list(event_id) OVER
             (PARTITION BY user_id ORDER BY ts, event_id ROWS 3 PRECEDING), ',') AS last_ids
    FROM events
    """,
)
def _(spark, sf):
    df = windows.last_n(_events(spark, sf), "event_id", "user_id", ORDER, 4, "ids")
    return df.select("event_id", "user_id", joined("ids").alias("last_ids"))


@query(
    "w13_sliding_lists",
    """
    SELECT event_id, user_id, array_to_string(l, ',') AS ids
    FROM (SELECT event_id, user_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS total,
                 list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 59 PRECEDING) AS l
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE rn >= 60 OR (total < 60 AND rn = total)
    """,
)
def _(spark, sf):
    df = windows.sliding_lists(_events(spark, sf), "event_id", "user_id", ORDER, 60, "w")
    return df.select("event_id", "user_id", joined("w").alias("ids"))


@query(
    "w14_monotonic",
    """
    SELECT event_id, user_id, value
    FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM events)
    WHERE value > greatest(coalesce(high, 0), 0)
    """,
)
def _(spark, sf):
    df = windows.monotonic(_events(spark, sf, "value"), "value", "user_id", ORDER)
    return df.select("event_id", "user_id", "value")


@query(
    "w15_running_histogram",
    """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS count_so_far
    FROM events
    """,
)
def _(spark, sf):
    df = windows.running_histogram(_events(spark, sf, "event_type"), "event_type", ORDER)
    return df.select("event_id", "event_type", "count_so_far")


@query(
    "w16_fill_forward",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
             (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase
    FROM events
    """,
)
def _(spark, sf):
    purchase = F.when(F.col("event_type") == "purchase", F.col("value"))
    df = windows.fill_forward(_events(spark, sf, "event_type", "value"), purchase, "user_id", ORDER, "last_purchase")
    return df.select("event_id", "user_id", "last_purchase")


# -- shaping ------------------------------------------------------------------


@query("p01_map", "SELECT event_id, round(value * 2 + 1, 2) AS y FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return shape.map_rows(df, y=F.round(F.col("value") * 2 + 1, 2)).drop("value")


@query("p02_filter", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def _(spark, sf):
    df = shape.keep(table(spark, sf, "lineitem"), (F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "p03_collect_cases",
    """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN round(value, 2) ELSE 0.0 END AS amount
    FROM events WHERE event_type IN ('purchase', 'signup')
    """,
)
def _(spark, sf):
    kind = F.col("event_type")
    cases = [(kind == "purchase", F.round("value", 2)), (kind == "signup", F.lit(0.0))]
    return shape.collect_cases(table(spark, sf, "events"), cases, "amount").select("event_id", "amount")


@query(
    "p04_flatten",
    "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents",
)
def _(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return shape.flatten(df, "words", "word")


@query("p05_duplicate", "SELECT event_id, unnest([1, 2]) AS copy FROM events")
def _(spark, sf):
    return shape.duplicate(table(spark, sf, "events").select("event_id"), "copy")


@query("p06_repeat_n", "SELECT event_id, CAST(unnest(range(1, user_id % 4 + 1)) AS INT) AS copy FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id")
    return shape.repeat(df, (F.col("user_id") % 4).cast("int"), "copy").drop("user_id")


@query(
    "p07_split_results",
    """
    SELECT CASE WHEN value < 10 THEN 'errors' ELSE 'results' END AS output, event_id,
           CASE WHEN value < 10 THEN concat('too small: ', event_id) END AS error
    FROM events
    """,
)
def _(spark, sf):
    error = F.when(F.col("value") < 10, F.concat(F.lit("too small: "), "event_id"))
    results, errors = shape.split_results(table(spark, sf, "events").select("event_id", "value"), error)
    results = results.withColumn("error", F.lit(None).cast("string"))
    out = results.withColumn("output", F.lit("results")).unionByName(errors.withColumn("output", F.lit("errors")))
    return out.select("output", "event_id", "error")


@query(
    "p08_above_running_average",
    """
    SELECT event_id, user_id, cents
    FROM (SELECT *, sum(cents) OVER w AS s, count(*) OVER w AS n
          FROM (SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
    WHERE cents * n >= s
    """,
)
def _(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    df = table(spark, sf, "events").select("event_id", "ts", "user_id", cents)
    return shape.above_running_average(df, "cents", "user_id", ORDER).drop("ts")


@query(
    "p09_resume_on_error",
    "SELECT event_id, round(value / (user_id % 5), 6) AS ratio FROM events WHERE user_id % 5 <> 0",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", (F.col("user_id") % 5).alias("d"))
    return shape.safe_divide(df, "value", "d", "ratio").select("event_id", F.round("ratio", 6).alias("ratio"))


@query(
    "p10_take_while",
    """
    SELECT event_id, user_id
    FROM (SELECT *, bool_or(event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                      ROWS UNBOUNDED PRECEDING) AS ended FROM events)
    WHERE NOT ended
    """,
)
def _(spark, sf):
    df = shape.take_while(_events(spark, sf, "event_type"), F.col("event_type") != "error", "user_id", ORDER)
    return df.select("event_id", "user_id")


@query(
    "p11_drop_while",
    """
    SELECT event_id, user_id
    FROM (SELECT *, bool_or(event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                      ROWS UNBOUNDED PRECEDING) AS begun FROM events)
    WHERE begun
    """,
)
def _(spark, sf):
    df = shape.drop_while(_events(spark, sf, "event_type"), F.col("event_type") != "error", "user_id", ORDER)
    return df.select("event_id", "user_id")


@query(
    "p12_drop_within",
    """
    SELECT event_id, user_id
    FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS first FROM events) WHERE ts >= first + INTERVAL 5 DAY
    """,
)
def _(spark, sf):
    return shape.drop_within(_events(spark, sf), "ts", "5 DAY", "user_id", ORDER).drop("ts")


@query(
    "p13_take_n_per_key",
    """
    SELECT event_id, user_id
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 3
    """,
)
def _(spark, sf):
    return shape.take(_events(spark, sf), 3, ORDER, "user_id").drop("ts")


@query(
    "p13_drop_n",
    """
    SELECT event_id, user_id
    FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) WHERE rn > 50
    """,
)
def _(spark, sf):
    return shape.drop(_events(spark, sf), 50, ORDER).drop("ts")


@query(
    "p13_take_n",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20",
)
def _(spark, sf):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return shape.take(table(spark, sf, "lineitem"), 20, order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )

"""Queries for decoding (F), sources and sinks (S)."""

from pyspark.sql import functions as F

from millrace.functions import decode, scalar
from millrace.operators import timewindows
from millrace.ordered import Ordered
from millrace.plans.registry import micros, query, table
from millrace.session import scratch_path
from millrace.sources import journal, readers, writers

# Events of the table stand for named events with a tab-separated payload; some names are
# unknown, some payloads short.
_NAME = "CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'play' WHEN 'purchase' THEN 'pause' WHEN 'signup' THEN 'forward' ELSE 'skip' END"


def _payload(sep: str) -> str:
    return f"""
    CASE WHEN value > 200 THEN concat('u', user_id)
         WHEN event_type = 'click' THEN concat('u', user_id, {sep}, 'page/', event_id)
         WHEN event_type = 'view' THEN concat('u', user_id, {sep}, event_id)
         WHEN value > 100 THEN concat('u', user_id, {sep}, event_id, {sep}, 'x1')
         ELSE concat('u', user_id, {sep}, event_id, {sep}, user_id * 100) END
    """


@query(
    "f01_decode_events",
    f"""
    WITH e AS (SELECT *, {_NAME} AS name, {_payload("chr(9)")} AS payload FROM events),
    d AS (SELECT *, CASE WHEN name = 'skip' THEN 'Did not find event skip'
                         WHEN value > 200 OR (name IN ('pause', 'forward') AND value > 100)
                         THEN concat('Could not decode event "', name, '" with payload "', payload, '"') END AS error FROM e)
    SELECT event_id, CASE WHEN error IS NULL THEN name END AS event_name,
           CASE WHEN error IS NULL THEN concat('u', user_id) END AS "user",
           CASE WHEN error IS NULL AND name = 'click' THEN concat('page/', event_id) END AS page,
           CASE WHEN error IS NULL AND name <> 'click' THEN event_id END AS track_id,
           CASE WHEN error IS NULL AND name IN ('pause', 'forward') THEN user_id * 100 END AS ts, error
    FROM d
    """,
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.expr(_NAME).alias("name"), F.expr(_payload("'\\t'")).alias("payload"))
    return df.select("event_id", decode.decode_event(F.col("name"), F.col("payload")).alias("e")).select("event_id", "e.*")


@query(
    "f02_safe_long",
    """
    SELECT event_id, CASE WHEN user_id % 4 <> 1 AND user_id % 4 <> 2 THEN CASE WHEN user_id % 4 = 3 THEN -user_id ELSE user_id END END AS n
    FROM events
    """,
)
def _(spark, sf):
    text = F.expr(
        "CASE user_id % 4 WHEN 0 THEN concat('', user_id) WHEN 1 THEN concat(user_id, '.5') "
        "WHEN 2 THEN concat(user_id, 'x') ELSE concat('-', user_id) END"
    )
    return table(spark, sf, "events").select("event_id", decode.safe_long(text).alias("n"))


@query("f03_unknown_event_names", "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'play', 'pause', 'forward')")
def _(spark, sf):
    return decode.unknown_event_names(table(spark, sf, "events"), "event_type")


@query(
    "f04_decode_telemetry",
    """
    SELECT event_id, concat('t', user_id) AS id, epoch_us(ts) // 1000 AS at, value AS power,
           CAST(props->>'$.k' AS DOUBLE) AS rotor_speed, CAST(NULL AS DOUBLE) AS wind_speed
    FROM events
    """,
)
def _(spark, sf):
    text = F.concat(
        F.lit('{"id": "t'), "user_id", F.lit('", "timestamp": '), F.floor(micros("ts") / 1000),
        F.lit(', "measurements": {"power": '), "value",
        F.lit(', "rotor_speed": '), F.get_json_object("props", "$.k"), F.lit("}}"),
    )
    df = table(spark, sf, "events").select("event_id", decode.decode_telemetry(text).alias("d"))
    return df.select("event_id", "d.id", F.col("d.timestamp").alias("at"), "d.measurements.*")


@query(
    "f05_split_csv_line",
    "SELECT event_id, event_type AS kind, value AS amount, user_id AS who, CAST(NULL AS BIGINT) AS missing FROM events",
)
def _(spark, sf):
    line = F.concat_ws(",", "event_id", "event_type", "value", "user_id")
    fields = decode.split_csv(line, event_id=(0, "bigint"), kind=(1, "string"), amount=(2, "double"), who=(3, "bigint"), missing=(7, "bigint"))
    return table(spark, sf, "events").select(*fields)


@query(
    "f06_fixed_chunks",
    """
    SELECT doc_id, CAST(k AS BIGINT) AS chunk_no, substr(text, CAST(k * 500 + 1 AS BIGINT), 500) AS chunk
    FROM (SELECT doc_id, text, unnest(range((length(text) - 1) // 500 + 1)) AS k FROM documents WHERE length(text) > 0)
    """,
)
def _(spark, sf):
    df = decode.chunk_text(table(spark, sf, "documents").select("doc_id", "text"), "text", 500)
    return df.withColumn("chunk_no", F.col("chunk_no").cast("long"))


@query(
    "f07_balanced_brackets",
    """
    SELECT page_id, n > 0 AND total = 0 AND low >= 0 AS balanced
    FROM (SELECT page_id, count(*) AS n, sum(d) AS total, min(depth) AS low
          FROM (SELECT page_id, d, sum(d) OVER (PARTITION BY page_id ORDER BY i) AS depth
                FROM (SELECT page_id, i, CASE substr(html, i, 1) WHEN '<' THEN 1 WHEN '>' THEN -1 ELSE 0 END AS d
                      FROM (SELECT page_id, html, unnest(range(1, length(html) + 1)) AS i FROM pages)) WHERE d <> 0)
          GROUP BY 1)
    """,
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", decode.balanced(F.col("html"), "<", ">").alias("balanced"))


@query("f11_widen", "SELECT l_linenumber, CAST(sum(CAST(l_linenumber AS DOUBLE)) AS DOUBLE) AS total FROM lineitem GROUP BY 1")
def _(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("x", scalar.widen(F.col("l_linenumber")))
    return df.groupBy("l_linenumber").agg(F.sum("x").alias("total"))


@query(
    "f12_round_half_even",
    """
    SELECT event_id, (CASE WHEN c % 10 < 5 THEN c // 10 WHEN c % 10 > 5 THEN c // 10 + 1 ELSE c // 10 + (c // 10) % 2 END) / 10.0 AS rounded
    FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS c FROM events)
    """,
)
def _(spark, sf):
    exact = F.col("value").cast("decimal(18,2)")
    return table(spark, sf, "events").select("event_id", scalar.round_half_even(exact, 1).cast("double").alias("rounded"))


@query("f13_shard_number", "SELECT event_id, CAST(user_id % 7 AS INT) AS shard FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", scalar.shard(F.col("user_id"), 7).alias("shard"))


# -- sources and sinks ----------------------------------------------------------


@query(
    "s01_csv_trips",
    "SELECT concat('m', user_id) AS medallion, round(value / 7, 4) AS pickup_lon, round(user_id / 3.0, 4) AS pickup_lat FROM events",
)
def _(spark, sf):
    path = scratch_path(spark, "trips")
    blank = F.lit("")
    table(spark, sf, "events").select(
        F.concat(F.lit("m"), "user_id"), "event_id", F.lit("CMT"), F.lit(1), F.lit("N"), "ts", "ts", F.lit(1), F.lit(60),
        F.lit(1.5), F.round(F.col("value") / 7, 4), F.round(F.col("user_id") / F.lit(3.0), 4), blank, blank,
    ).toDF(*[f.name for f in readers.TRIP.fields]).write.csv(path)
    return readers.read_trips(spark, path).select("medallion", "pickup_lon", "pickup_lat")


@query(
    "s02_line_frames",
    """
    SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS frame_no, unnest(l) AS frame, length(unnest(l)) > 200 AS too_long
    FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l FROM documents WHERE length(text) > 0)
    """,
)
def _(spark, sf):
    return readers.column_frames(table(spark, sf, "documents").select("doc_id", "text"), "text", 200)


@query("s03_unwrap_json_array", "SELECT event_id, CAST(unnest([props->>'$.k', CAST(user_id AS VARCHAR)]) AS BIGINT) AS k FROM events")
def _(spark, sf):
    text = F.concat(F.lit("["), "props", F.lit(', {"k": '), "user_id", F.lit("}]"))
    df = table(spark, sf, "events").select("event_id", text.alias("text"))
    return decode.unwrap_json_array(df, "text", "struct<k:bigint>", "e").select("event_id", "e.k")


@query("s07_paced_numbers", "SELECT event_id, 1704067200000000 + 5000000 + event_id * 250000 AS at FROM events")
def _(spark, sf):
    """As many numbers as there are events, joined back to them."""
    events = table(spark, sf, "events").select("event_id")
    top = events.agg(F.max("event_id")).first()[0]
    numbers = readers.number_source(spark, 0, top + 1, "2024-01-01 00:00:00", 5, 0.25)
    return numbers.withColumnRenamed("value", "event_id").join(events, "event_id", "left_semi").select("event_id", micros("ts").alias("at"))


@query(
    "s08_journal_read",
    """
    SELECT user_id AS persistence_id, seq AS sequence_nr, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                    + CASE WHEN user_id % 3 = 0 AND row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) > 35 THEN 25 ELSE 0 END AS seq
          FROM events)
    WHERE seq >= 15 AND NOT (user_id % 3 = 0 AND seq > 35)
    """,
)
def _(spark, sf):
    """Every third journal has a hole of 25 numbers, so that a whole partition is empty."""
    path = scratch_path(spark, "journal")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    rows = Ordered.of(events, "user_id", ["ts", "event_id"]).position("n").df
    seq = F.when((F.col("user_id") % 3 == 0) & (F.col("n") > 35), F.col("n") + 25).otherwise(F.col("n"))
    journal.write_journal(
        rows.select(F.col("user_id").alias("persistence_id"), seq.alias("sequence_nr"), "event_id"), path, 10
    )
    return journal.read_journal(spark, path, 15, 10).select("persistence_id", "sequence_nr", "event_id")


@query("s09_last_seen", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def _(spark, sf):
    df = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return readers.last_seen(df, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "s10_copy_lines",
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) "
    "WHERE trim(line) <> '' AND line NOT LIKE '//%' GROUP BY 1",
)
def _(spark, sf):
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "copy")
    table(spark, sf, "documents").select("text").write.text(source)
    writers.copy_text(spark, source, target)
    return spark.read.text(target).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s11_stage_counts",
    """
    SELECT 'all' AS stage, epoch_us(date_trunc('day', ts)) AS window_start, count(*) AS n FROM events GROUP BY 2
    UNION ALL
    SELECT 'purchases', epoch_us(date_trunc('day', ts)), count(*) FROM events WHERE event_type = 'purchase' GROUP BY 2
    """,
)
def _(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_type")
    df = writers.stage_counts({"all": events, "purchases": events.where("event_type = 'purchase'")}, "ts", "1 day")
    return df.withColumn("window_start", micros("window_start"))


@query(
    "s12_batch_numbers",
    "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch_no FROM events",
)
def _(spark, sf):
    df = timewindows.batches(table(spark, sf, "events").select("event_id", "ts"), 100, ["ts", "event_id"])
    return df.select("event_id", "batch_no")

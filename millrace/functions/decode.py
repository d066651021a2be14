"""Decoding of delimited, JSON and framed text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Known events and the number of fields in their payload (fixed values).
EVENT_FIELDS = {"click": 2, "play": 2, "pause": 3, "forward": 3}

EVENT = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("track_id", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

TELEMETRY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField(
            "measurements",
            T.StructType([T.StructField(n, T.DoubleType()) for n in ("power", "rotor_speed", "wind_speed")]),
        ),
    ]
)


def safe_long(text: Column) -> Column:
    """A whole number of up to 64 bits, else null; no blanks, no fraction."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def decode_event(name: Column, payload: Column) -> Column:
    """A typed event from its name and tab-separated payload, or an error text."""
    # trailing empty fields do not count
    fields = F.split(F.regexp_replace(payload, r"\t+\z", ""), "\t")
    field = lambda i: F.try_element_at(fields, F.lit(i + 1))
    track, at = safe_long(field(1)), safe_long(field(2))
    known = name.isin(list(EVENT_FIELDS))
    right_size = F.lit(False)
    for event, n in EVENT_FIELDS.items():
        right_size = right_size | ((name == event) & (F.size(fields) == n))
    timed = name.isin("pause", "forward")
    ok = right_size & ((name == "click") | (track.isNotNull() & (~timed | at.isNotNull())))
    error = F.when(~known, F.concat(F.lit("Did not find event "), name)).when(
        ~ok, F.concat(F.lit('Could not decode event "'), name, F.lit('" with payload "'), payload, F.lit('"'))
    )
    return F.struct(
        F.when(ok, name).alias("event_name"),
        F.when(ok, field(0)).alias("user"),
        F.when(ok & (name == "click"), field(1)).alias("page"),
        F.when(ok & (name != "click"), track).alias("track_id"),
        F.when(ok & timed, at).alias("ts"),
        error.alias("error"),
    )


def known_event_names() -> list[str]:
    return list(EVENT_FIELDS)


def unknown_event_names(df: DataFrame, name: str) -> DataFrame:
    """Event names in the data that no decoder knows."""
    return df.select(name).distinct().where(~F.col(name).isin(known_event_names()))


def decode_telemetry(text: Column) -> Column:
    return F.from_json(text, TELEMETRY)


def unwrap_json_array(df: DataFrame, text: str, element: T.DataType | str, out: str = "element") -> DataFrame:
    """One row per element of a JSON array held as text."""
    kind = element.simpleString() if isinstance(element, T.DataType) else element
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.explode(F.from_json(text, f"array<{kind}>")).alias(out))


def split_csv(line: Column, **casts: tuple[int, str]) -> list[Column]:
    """Fields of a comma-separated line by position: ``lon=(10, "double")``; null where
    missing or not castable."""
    fields = F.split(line, ",")
    return [
        F.try_element_at(fields, F.lit(i + 1)).try_cast(kind).alias(name) for name, (i, kind) in casts.items()
    ]


def frame_lines(df: DataFrame, text: str, max_length: int = 10_000, out: str = "frame") -> DataFrame:
    """Newline frames of a text column, numbered from 0; ``too_long`` marks frames above
    the limit. The last frame may lack its newline; a closing newline adds none."""
    others = [c for c in df.columns if c != text]
    frames = F.split(F.regexp_replace(F.col(text), r"\n\z", ""), "\n")
    rows = df.where(F.length(text) > 0).select(*others, F.posexplode(frames).alias("frame_no", out))
    return rows.withColumn("too_long", F.length(out) > max_length)


def chunk_text(df: DataFrame, text: str, size: int, out: str = "chunk") -> DataFrame:
    """Chunks of ``size`` characters (bytes, for a binary column), numbered from 0; the
    last one may be short."""
    others = [c for c in df.columns if c != text]
    starts = F.sequence(F.lit(0), F.expr(f"(length({text}) - 1) div {size}"))
    rows = df.where(F.length(text) > 0).select("*", F.explode(starts).alias("chunk_no"))
    return rows.select(*others, "chunk_no", F.substring(F.col(text), F.col("chunk_no") * size + 1, F.lit(size)).alias(out))


def balanced(text: Column, opening: str = "{", closing: str = "}") -> Column:
    """Do the brackets of a text match? Other characters are passed over; a text without
    brackets is not balanced.

    Matched innermost pairs cannot be removed by a bounded regular expression, so the
    depth is followed over the brackets only.
    """
    brackets = F.split(F.regexp_replace(text, f"[^\\{opening}\\{closing}]", ""), "")
    # (depth, went below zero)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("below"))

    def step(acc: Column, c: Column) -> Column:
        depth = acc["depth"] + F.when(c == opening, 1).when(c == closing, -1).otherwise(0)
        return F.struct(depth.alias("depth"), (acc["below"] | (depth < 0)).alias("below"))

    end = F.aggregate(brackets, start, step)
    return (F.length(F.array_join(brackets, "")) > 0) & (end["depth"] == 0) & ~end["below"]

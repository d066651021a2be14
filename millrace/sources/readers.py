"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.decode import frame_lines
from millrace.functions.geometry import shape_of
from millrace.operators.geo import RINGS

# Trip log without header; the order of the fields is fixed.
TRIP = T.StructType(
    [
        T.StructField("medallion", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("rate_code", T.IntegerType()),
        T.StructField("flag", T.StringType()),
        T.StructField("pickup_ts", T.TimestampNTZType()),
        T.StructField("dropoff_ts", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_seconds", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_lon", T.DoubleType()),
        T.StructField("pickup_lat", T.DoubleType()),
        T.StructField("dropoff_lon", T.DoubleType()),
        T.StructField("dropoff_lat", T.DoubleType()),
    ]
)

# Geometries stay text until ``geometry.shape_of`` reads them.
FEATURE = "struct<id:string,properties:map<string,string>,geometry:string>"
COLLECTION = f"struct<type:string,features:array<{FEATURE}>>"


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips from comma-separated files; split into tasks by Spark, columns pruned."""
    return spark.read.schema(TRIP).csv(path)


def read_lines(spark: SparkSession, path: str, max_length: int = 10_000) -> DataFrame:
    """Lines of text files, with a mark on over-long ones."""
    return spark.read.text(path).select(F.col("value").alias("frame"), (F.length("value") > max_length).alias("too_long"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array, one row per element. A file is one task, as a
    JSON array has no safe split point; write large data as many files or JSON lines."""
    return spark.read.schema(schema).json(path, multiLine=True)


def features_of(df: DataFrame, text: str) -> DataFrame:
    """``(id, properties, geometry, rings)`` of the features in GeoJSON FeatureCollection texts.
    ``geometry`` is of ``geometry.SHAPE``, any type of geometry with an error where it cannot be
    read; ``rings`` are those of a geometry that is one polygon, else null."""
    features = df.select(F.explode(F.from_json(text, COLLECTION)["features"]).alias("f"))
    shaped = features.select("f.id", "f.properties", shape_of("f.geometry").alias("geometry"))
    parts = F.size("geometry.points") + F.size("geometry.lines") + F.size("geometry.polygons")
    return shaped.withColumn("rings", F.when((parts == 1) & (F.size("geometry.polygons") == 1), F.col("geometry.polygons")[0]).cast(RINGS))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files."""
    return features_of(spark.read.text(path, wholetext=True), "value")


def number_source(
    spark: SparkSession, start: int, limit: int, t0: str, delay_seconds: float = 0, interval_seconds: float = 1
) -> DataFrame:
    """Numbers ``start`` to ``limit - 1``, one per interval from ``t0`` plus the delay."""
    offset = F.lit(delay_seconds) + (F.col("value") - start) * F.lit(interval_seconds)
    micros = F.round(offset * 1_000_000).cast("long")
    ts = F.expr("timestampadd(MICROSECOND, _us, _t0)")
    return (
        spark.range(start, limit)
        .toDF("value")
        .withColumns({"_us": micros, "_t0": F.lit(t0).cast("timestamp_ntz")})
        .select("value", ts.alias("ts"))
    )


def number_stream(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, interval_ms: int = 1000, limit: int | None = None) -> DataFrame:
    """The same as a stream: a fixed number of rows per micro-batch, time advancing by a
    fixed step."""
    rows = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", interval_ms)
        .load()
    )
    return rows if limit is None else rows.where(F.col("value") < limit)


def tail_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A growing folder of text files as an endless stream of lines. New *files* are seen;
    lines appended to a file already read are not, so let the writer rotate files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).withColumnRenamed("value", "frame")


def column_frames(df: DataFrame, text: str, max_length: int = 10_000) -> DataFrame:
    return frame_lines(df, text, max_length)


def last_seen(df: DataFrame, key: list[str] | str, order_by: list[str] | str) -> DataFrame:
    """The last element of each key."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row")).select("_row.*")

"""Writers and counters."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.geometry import geometry_json


def feature_json(df: DataFrame, properties: list[str]) -> Column:
    """A GeoJSON feature from ``id``, the property columns and ``geometry`` (a shape) or, without
    one, the ``rings`` of a polygon."""
    if "geometry" in df.columns:
        geometry = geometry_json("geometry")
    else:
        coordinates = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
        geometry = F.to_json(F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")))
    head = F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("id").cast("string").alias("id"), F.struct(*properties).alias("properties")))
    return F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"geometry":'), geometry, F.lit("}"))


def write_features(df: DataFrame, path: str, properties: list[str]) -> None:
    """One feature per line (newline-delimited GeoJSON), so that any number is written in
    parallel; a reader that wants a collection wraps the lines."""
    df.select(feature_json(df, properties).alias("value")).write.text(path)


def feature_collections(features: DataFrame, properties: list[str], n: int = 10_000) -> DataFrame:
    """FeatureCollection texts (``value``), each of up to ``n`` features and made by one task, so
    that any number is written in parallel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= n:
                yield collection(held[:n])
                held = held[n:]
        if held:
            yield collection(held)

    def collection(texts: list[str]) -> pa.RecordBatch:
        text = '{"type":"FeatureCollection","features":[' + ",".join(texts) + "]}"
        return pa.RecordBatch.from_arrays([pa.array([text])], names=["value"])

    return features.select(feature_json(features, properties).alias("value")).mapInArrow(run, "value string")


def code_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are neither blank nor comments."""
    return lines.where((F.trim(F.col(column)) != "") & ~F.col(column).startswith("//"))


def copy_text(spark: SparkSession, source: str, target: str) -> None:
    """Copy text files without blank and comment lines."""
    code_lines(spark.read.text(source)).write.text(target)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted as they pass; read the count after the action from
    ``observation.get['n']``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n")), observation


def stage_counts(stages: Mapping[str, DataFrame], ts: str, duration: str) -> DataFrame:
    """Counts of several stages per window: ``(stage, window_start, n)``. Each stage is
    counted before the union, so only counts are merged."""
    parts = [
        df.groupBy(F.window(ts, duration).start.alias("window_start"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(stage).alias("stage"), "window_start", "n")
        for stage, df in stages.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch under its number. A repeated batch replaces its own files only, so
    at-least-once delivery leaves the table right."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def show(df: DataFrame, n: int = 20) -> None:
    """Print some rows."""
    df.show(n, truncate=False)

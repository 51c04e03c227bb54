"""Device telemetry: decoding, raw rows, averages and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import records, text


def decode(envelopes: DataFrame) -> DataFrame:
    """Body bytes to text without line ends; the property map stays."""
    return envelopes.select(text.strip_crlf(records.utf8(F.col("body"))).alias("value"), "properties")


def event_properties(envelopes: DataFrame) -> DataFrame:
    """The two properties every event carries, as columns."""
    return envelopes.select(
        F.try_element_at("properties", F.lit("content-type")).alias("content_type"),
        F.try_element_at("properties", F.lit("source")).alias("source"),
    )


def metric_rows(envelopes: DataFrame) -> DataFrame:
    """(g, k, t, v), one row per entry of every body; ``v`` stays text."""
    batch = F.from_json(records.utf8(F.col("body")), schemas.METRIC_BATCH)
    return envelopes.select(F.explode(batch["Data"]).alias("m")).select("m.g", "m.k", "m.t", "m.v")


def metric_pairs(envelopes: DataFrame) -> DataFrame:
    """(k, value) with value = (v, t), taken from the body as string maps."""
    entry = "struct<Data: array<map<string,string>>>"
    batch = F.from_json(records.utf8(F.col("body")), entry)
    field = lambda name: F.try_element_at("m", F.lit(name))
    return envelopes.select(F.explode(batch["Data"]).alias("m")).select(
        field("k").alias("k"), F.struct(field("v").alias("v"), field("t").alias("t")).alias("value")
    )


def event_time(t: Column, epoch_offset_ms: int = 0) -> Column:
    """Milliseconds of the device clock as a timestamp."""
    return F.timestamp_millis(t - F.lit(epoch_offset_ms))


def with_time(metrics: DataFrame, epoch_offset_ms: int = 0) -> DataFrame:
    return metrics.withColumn("ts", event_time(F.col("t"), epoch_offset_ms))


def _statistics() -> list[Column]:
    v = records.number(F.col("v"))
    return [
        F.avg(v).alias("average_value"),
        F.count(v).alias("n"),
        (F.count("*") - F.count(v)).alias("rejects"),
    ]


def average(metrics: DataFrame) -> DataFrame:
    """Mean per metric; values that are no numbers are counted as rejects."""
    return metrics.groupBy("k").agg(*_statistics())


def windowed_average(metrics: DataFrame, size: str = "90 seconds", slide: str | None = "30 seconds") -> DataFrame:
    """Mean per metric and event-time window; ``metrics`` carries ``ts``."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (
        metrics.groupBy(window.alias("w"), "k")
        .agg(*_statistics())
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "k",
            "average_value",
            "n",
            "rejects",
        )
    )


def windowed_sum(metrics: DataFrame, size: str = "1 minute") -> DataFrame:
    return (
        metrics.groupBy(F.window("ts", size).alias("w"), "k")
        .agg(F.sum(records.number(F.col("v"))).alias("total_value"))
        .select(F.col("w.start").alias("window_start"), "k", "total_value")
    )

"""Streaming readers. Every job takes any streaming DataFrame of the same shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def text_lines(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None, arrival: bool = False
) -> DataFrame:
    """``value STRING`` lines of files that land in a folder.

    ``arrival`` adds ``arrived``, the time at which a line's file landed. It belongs to the
    file, so a batch that is replayed has the same times.
    """
    lines = _limited(spark.readStream.format("text"), files_per_trigger).load(folder)
    arrived = [F.col("_metadata.file_modification_time").alias("arrived")] if arrival else []
    return lines.select("value", *arrived)


def message_files(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Social messages of JSON-lines files that land in a folder."""
    return _limited(spark.readStream.format("json").schema(schemas.MESSAGE), files_per_trigger).load(folder)


def envelope_files(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Event envelopes (body, properties) of parquet files that land in a folder."""
    return _limited(spark.readStream.format("parquet").schema(schemas.ENVELOPE), files_per_trigger).load(folder)


def _limited(reader, files_per_trigger: int | None):
    return reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)


def kafka_options(
    servers: str, topic: str, min_partitions: int = 4, group: str | None = None, starting: str = "latest"
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "minPartitions": str(min_partitions),
        "startingOffsets": starting,
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(spark: SparkSession, options: Mapping[str, str], arrival: bool = False) -> DataFrame:
    """``value STRING`` lines of a Kafka topic; needs the Kafka connector on the cluster.

    ``arrival`` adds ``arrived``, the time that the broker keeps with a record.
    """
    arrived = [F.col("timestamp").alias("arrived")] if arrival else []
    return _kafka(spark, options).select(F.col("value").cast("string").alias("value"), *arrived)


def kafka_envelopes(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Event envelopes of a Kafka topic, record headers as the property map."""
    return _kafka(spark, {**options, "includeHeaders": "true"}).select(
        F.col("value").alias("body"), header_map(F.col("headers")).alias("properties")
    )


def header_map(headers: Column) -> Column:
    """Record headers as a map of texts; of a key that is given twice the last value counts."""
    texts = F.transform(headers, lambda h: F.struct(h["key"], F.decode(h["value"], "UTF-8").alias("value")))
    later = lambda h, i: F.exists(F.slice(texts, i + 2, F.size(texts)), lambda x: x["key"] == h["key"])
    last = F.filter(texts, lambda h, i: ~later(h, i) & h["key"].isNotNull())
    return F.map_from_entries(last).cast(T.MapType(T.StringType(), T.StringType()))


def kafka_broker(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """``topic, value`` pairs, as a broker subscription gives them."""
    return _kafka(spark, options).select("topic", F.col("value").cast("string").alias("value"))


def _kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()

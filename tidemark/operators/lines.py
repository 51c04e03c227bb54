"""Line numbers of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def numbered_lines(spark: SparkSession, path: str, lo: int = 1, hi: int | None = None) -> DataFrame:
    """Lines ``lo <= n < hi`` (1-based) of a file, or of a folder's files in name order.

    Each split counts its own lines; a running total over one row per split
    gives its first line number. Splits outside the range are left out by a
    join with the summary rows, so a short slice shuffles no lines.
    """
    splits = ["_path", "_offset"]
    lines = (
        spark.read.text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_offset"),
            F.monotonically_increasing_id().alias("_at"),
        )
    )
    counted = lines.groupBy(*splits).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    before = Window.orderBy(*splits).rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    wanted = starts.where(F.col("_start") + F.col("_rows") >= lo)
    if hi is not None:
        wanted = wanted.where(F.col("_start") + 1 < hi)
    numbered = lines.join(wanted, splits).select(
        (F.col("_start") + F.col("_at") - F.col("_from") + 1).alias("n"), "value"
    )
    kept = numbered.where(F.col("n") >= lo)
    return kept if hi is None else kept.where(F.col("n") < hi)


def first_lines(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """The first ``rows`` lines in file order."""
    return numbered_lines(spark, path, 1, rows + 1)

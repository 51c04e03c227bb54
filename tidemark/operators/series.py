"""Ordered series: running mean, last points, rolling mean, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scan import prefix_totals, with_ordinal

# Rows of one series that a rolling window handles together.
_PIECE = 2_000
# Parts of a series that each find their newest points first.
_PARTS = 64


def sine(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return points.withColumn(y, F.sin(x))


def running_mean(points: DataFrame, series: str = "series", x: str = "x", y: str = "y") -> DataFrame:
    """Mean of all points of the series up to this one, by ``x``; points without a value don't count."""
    values = {"_sum": F.col(y), "_n": F.col(y).isNotNull().cast("bigint")}
    scanned = prefix_totals(points.select(series, x, y), [series], [x], values)
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))
    return scanned.select(series, x, y, mean.alias("avg"))


def ordinals(points: DataFrame, series: str = "series", x: str = "x") -> DataFrame:
    """1-based position of every row in its series, as ``n``."""
    return prefix_totals(points, [series], [x], {"n": F.lit(1).cast("bigint")}).drop("n_total")


def last_points(points: DataFrame, keep: int = 100, series: str = "series", x: str = "x") -> DataFrame:
    """The newest points of every series.

    Each part of a series keeps its newest, then the series those of its parts, so that a
    long series meets in one task with ``keep`` rows a part only. Parts follow the input's
    tasks, so that a task, which limits its rows before they move, passes on one part.
    """
    part = F.spark_partition_id() % _PARTS
    of_part = F.row_number().over(Window.partitionBy(series, "_part").orderBy(F.desc(x)))
    newest = F.row_number().over(Window.partitionBy(series).orderBy(F.desc(x)))
    few = points.withColumn("_part", part).withColumn("_n", of_part).where(F.col("_n") <= keep).drop("_n", "_part")
    return few.withColumn("_n", newest).where(F.col("_n") <= keep).drop("_n")


def rolling_mean(
    points: DataFrame, size: int = 100, series: str = "series", x: str = "x", y: str = "y", piece: int = _PIECE
) -> DataFrame:
    """Mean over the last ``size`` points of the series, this one included.

    Rows are numbered, cut into pieces of equal length, and the last rows of a
    piece are lent to the next one, so no task needs more than one piece at a time.
    """
    numbered = ordinals(points.select(series, x, y), series, x)
    own = F.floor((F.col("n") - 1) / piece)
    reach = F.floor((F.col("n") + size - 2) / piece)
    lent = numbered.withColumn("_own", own).withColumn("_piece", F.explode(F.sequence(own, reach)))
    frame = Window.partitionBy(series, "_piece").orderBy("n").rowsBetween(1 - size, 0)
    return (
        lent.withColumn("avg", F.avg(y).over(frame))
        .where(F.col("_piece") == F.col("_own"))
        .select(series, x, y, "avg")
    )


def rename(records: DataFrame, names: Sequence[str]) -> DataFrame:
    return records.toDF(*names)


def complete(records: DataFrame) -> DataFrame:
    """Records without any missing field."""
    return records.na.drop()


def replay(records: DataFrame, order: Sequence[str], skip: int = 1) -> DataFrame:
    """Rows numbered along ``order``, starting after the first ``skip`` rows."""
    return with_ordinal(records, order).where(F.col("n") > skip)

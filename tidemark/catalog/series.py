"""Series, sensor and small-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import lines, series
from ..session import scratch_path
from ..sources import files, testdata
from . import query
from .fixtures import SENSOR

# What the event types stand for.
PURPOSES = [
    ("click", "engagement"),
    ("view", "engagement"),
    ("purchase", "revenue"),
    ("signup", "revenue"),
    ("error", "fault"),
]


@query("""SELECT p.purpose, count(*) AS n FROM events LEFT JOIN (VALUES ('click', 'engagement'), ('view', 'engagement'),
('purchase', 'revenue'), ('signup', 'revenue'), ('error', 'fault')) p(event_type, purpose) USING (event_type)
GROUP BY p.purpose""")
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows with an explicit schema, used to label every event."""
    purposes = spark.createDataFrame(PURPOSES, "event_type string, purpose string")
    events = testdata.table(spark, sf_dir, "events")
    return events.join(purposes, "event_type", "left").groupBy("purpose").agg(F.count("*").alias("n"))


def _sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rename(testdata.sensor(spark, sf_dir), schemas.SENSOR_COLUMNS)


@query(f"WITH {SENSOR} SELECT * FROM sensor")
def sensor_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor records read from JSON files, renamed by position."""
    records = testdata.sensor(spark, sf_dir)
    path = scratch_path(spark, "sensor")
    records.write.json(path)
    return files.read_sensor_json(spark, path, records.schema)


@query(f"WITH {SENSOR} SELECT * FROM sensor WHERE w_z IS NOT NULL")
def sensor_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.complete(_sensor(spark, sf_dir))


@query(f"""WITH {SENSOR}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY product_id NULLS FIRST, qc_lot NULLS FIRST, "time" NULLS FIRST,
         w_x NULLS FIRST, w_y NULLS FIRST, w_z NULLS FIRST) AS n FROM sensor)
SELECT * FROM numbered WHERE n > 1""")
def ordinal_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records in a fixed order with their row number, without the first."""
    return series.replay(_sensor(spark, sf_dir), schemas.SENSOR_COLUMNS)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type: whole cents, so that sums are exact.

    Some points have no value, some no series, and each series has one without a place.
    """
    cents = F.when(F.col("event_id") % 13 != 0, F.round(F.col("value") * 100))
    series = F.when(F.col("event_id") % 31 != 0, F.col("event_type"))
    x = F.when(F.col("event_id") != F.col("first"), F.col("event_id"))
    events = testdata.table(spark, sf_dir, "events").withColumn("series", series)
    firsts = events.groupBy(F.col("series").alias("s")).agg(F.min("event_id").alias("first"))
    events = events.join(firsts, F.col("series").eqNullSafe(F.col("s")))
    return events.select("series", x.alias("x"), cents.alias("y"))


_POINTS = """typed AS (SELECT *, CASE WHEN event_id % 31 <> 0 THEN event_type END AS series FROM events),
points AS (SELECT series, CASE WHEN event_id <> min(event_id) OVER (PARTITION BY series) THEN event_id END AS x,
                  CASE WHEN event_id % 13 <> 0 THEN round(value * 100) END AS y FROM typed)"""


@query(f"""WITH {_POINTS} SELECT series, x, round(sin(x), 6) AS y,
round(avg(sin(x)) OVER (PARTITION BY series ORDER BY x NULLS FIRST ROWS UNBOUNDED PRECEDING), 6) AS "avg" FROM points""")
def running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sine of a counter and its mean so far."""
    means = series.running_mean(series.sine(_points(spark, sf_dir)))
    return means.select("series", "x", F.round("y", 6).alias("y"), F.round("avg", 6).alias("avg"))


@query(f"""WITH {_POINTS} SELECT series, x, y,
avg(y) OVER w AS "avg" FROM points
WINDOW w AS (PARTITION BY series ORDER BY x NULLS FIRST ROWS UNBOUNDED PRECEDING)""")
def running_mean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.running_mean(_points(spark, sf_dir))


@query(f"""WITH {_POINTS}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY x DESC NULLS LAST) AS place FROM points)
SELECT series, x, y FROM newest WHERE place <= 100""")
def last_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.last_points(_points(spark, sf_dir), 100)


@query(f"""WITH {_POINTS} SELECT series, x, y, avg(y) OVER w AS "avg" FROM points
WINDOW w AS (PARTITION BY series ORDER BY x NULLS FIRST ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rolling_mean(_points(spark, sf_dir), 100)


@query(f"""WITH {_POINTS} SELECT series, x, row_number() OVER (PARTITION BY series ORDER BY x NULLS FIRST) AS n FROM points""")
def series_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.ordinals(_points(spark, sf_dir).select("series", "x"))


@query("""SELECT n, conv_id || '/' || turn || '/' || role AS value FROM (
  SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations) WHERE n >= 20 AND n < 60""")
def line_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 20 to 59 of all turns, written in order as text part files."""
    path = scratch_path(spark, "turns")
    turns = testdata.table(spark, sf_dir, "conversations").orderBy("conv_id", "turn")
    turns.select(F.concat_ws("/", "conv_id", "turn", "role")).write.text(path)
    return lines.numbered_lines(spark, path, 20, 60)

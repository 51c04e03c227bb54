"""Device telemetry and broker queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import broker as br
from ..operators import metrics as mt
from ..session import scratch_path
from ..sources import files, testdata
from . import query
from .fixtures import BROKER, METRICS

FILTER = "/applications/in/+/public/#"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.metric_rows(testdata.envelopes(spark, sf_dir))


def plain(windowed: DataFrame, digits: int = 6) -> DataFrame:
    """Window bounds without time zone and rounded values, for comparison."""
    changed = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end") if c in windowed.columns}
    changed |= {c: F.round(c, digits) for c in ("average_value", "total_value") if c in windowed.columns}
    return windowed.withColumns(changed)


@query(f"""WITH {METRICS}
SELECT '{{"Data":[{{"g":"' || g || '","k":"' || event_type || '","v":"' || v || '","t":' || t || '}},{{"g":"' || g
       || '","k":"' || event_type || '_k","v":"' || kk || '","t":' || t || '}}]}}' AS value,
       'device-' || user_id AS source
FROM device""")
def decode_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = mt.decode(testdata.envelopes(spark, sf_dir))
    return decoded.select("value", F.try_element_at("properties", F.lit("source")).alias("source"))


@query("SELECT 'application/json' AS content_type, 'device-' || user_id AS source FROM events")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.event_properties(testdata.envelopes(spark, sf_dir))


@query(f"WITH {METRICS} SELECT g, k, t, v FROM metrics")
def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir)


@query(f"WITH {METRICS} SELECT g, k, t, v FROM metrics")
def metric_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows written as head-less CSV part files and scanned as a folder."""
    path = scratch_path(spark, "metrics")
    files.write_metric_csv(_metrics(spark, sf_dir), path)
    return files.read_metric_csv(spark, path)


@query(f"WITH {METRICS} SELECT k, v, CAST(t AS VARCHAR) AS t FROM metrics")
def metric_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.metric_pairs(testdata.envelopes(spark, sf_dir)).select("k", "value.v", "value.t")


_STATS = "round(avg(num), 6) AS average_value, count(num) AS n, count(*) - count(num) AS rejects"


@query(f"WITH {METRICS} SELECT k, {_STATS} FROM metrics GROUP BY k")
def metric_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mt.average(_metrics(spark, sf_dir)))


def windows_sql(size_ms: int, slide_ms: int) -> str:
    """SQL that puts every metric row into each window that holds it."""
    return f"""WITH {METRICS}, placed AS (
  SELECT *, t - t % {slide_ms} - unnest(range(0, {size_ms // slide_ms})) * {slide_ms} AS lo FROM metrics)
SELECT make_timestamp(lo * 1000) AS window_start, make_timestamp((lo + {size_ms}) * 1000) AS window_end,
       k, {_STATS} FROM placed GROUP BY lo, k"""


def _windowed(spark: SparkSession, sf_dir: str, size: str, slide: str | None) -> DataFrame:
    return plain(mt.windowed_average(mt.with_time(_metrics(spark, sf_dir)), size, slide))


@query(windows_sql(30_000, 30_000))
def metric_avg_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(spark, sf_dir, "30 seconds", None)


@query(windows_sql(90_000, 30_000))
def metric_avg_90_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(spark, sf_dir, "90 seconds", "30 seconds")


@query(windows_sql(7_200_000, 3_600_000))
def metric_avg_2h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(spark, sf_dir, "2 hours", "1 hour")


@query(f"""WITH {METRICS} SELECT make_timestamp((t - t % 60000) * 1000) AS window_start, k,
round(sum(num), 6) AS total_value FROM metrics GROUP BY ALL""")
def metric_sum_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mt.windowed_sum(mt.with_time(_metrics(spark, sf_dir)), "1 minute"))


@query(f"""WITH {BROKER}, sats AS (SELECT *, unnest([0, 1]) AS i FROM broker)
SELECT topic, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS t, CAST(user_id + i AS INTEGER) AS "PRN",
       CAST(kk AS INTEGER) AS el, CAST((user_id * 2 + i) % 360 AS INTEGER) AS az,
       CAST(kk % 40 * i AS INTEGER) AS ss, kk % 40 * i > 0 AS used
FROM sats""")
def satellite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return br.satellite_rows(testdata.broker(spark, sf_dir))


@query(f"""WITH {BROKER} SELECT topic, count(*) AS n FROM broker
WHERE regexp_full_match(topic, '/applications/in/[^/]+/public(/.*)?') GROUP BY topic""")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = br.subscribe(testdata.broker(spark, sf_dir), FILTER)
    return accepted.groupBy("topic").agg(F.count("*").alias("n"))


# Filters of six kinds, from the orders; those of the last kind accept nothing.
_MANY = """flt AS (
  SELECT *, CASE kind
    WHEN 0 THEN '/applications/in/' || u || '/public/' || t
    WHEN 1 THEN '/applications/in/' || u || '/+/' || t
    WHEN 2 THEN '/applications/in/' || u || '/#'
    WHEN 3 THEN '/applications/+/' || u || '/private/#'
    WHEN 4 THEN '/applications/in/+/' || w || '/' || t
    ELSE '/applications/in/' || u || '/public/' || t || '/' || o_orderkey || '/#' END AS filter
  FROM (SELECT o_orderkey, o_orderkey % 6 AS kind, o_custkey % 150 AS u,
               CASE WHEN o_custkey % 2 = 0 THEN 'public' ELSE 'private' END AS w,
               CASE o_custkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                 WHEN 3 THEN 'signup' ELSE 'view' END AS t FROM orders))"""


@query(f"""WITH {BROKER}, {_MANY},
wanted AS (SELECT DISTINCT filter, kind, u, CASE WHEN kind = 4 THEN w END AS w, t FROM flt),
said AS (SELECT topic, user_id AS u, split_part(topic, '/', 5) AS w, event_type AS t, count(*) AS n FROM broker GROUP BY ALL)
SELECT f.filter, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT DISTINCT f.filter, s.topic, s.n FROM wanted f JOIN said s ON
    (f.kind = 4 OR f.u = s.u) AND (f.kind NOT IN (0, 1, 4) OR f.t = s.t)
    AND CASE f.kind WHEN 0 THEN s.w = 'public' WHEN 3 THEN s.w = 'private' WHEN 4 THEN s.w = f.w ELSE f.kind < 5 END) f
GROUP BY f.filter""")
def many_topic_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that each of thousands of broker filters accepts."""
    orders = testdata.table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("orders_of_filters")
    filters = spark.sql(f"WITH {_MANY.replace('FROM orders', 'FROM orders_of_filters')} SELECT filter FROM flt")
    counts = testdata.broker(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("n"))
    return br.route(counts, filters).groupBy("filter").agg(F.sum("n").alias("n"))

"""Streaming jobs run to the end over files made from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import messages as msg
from ..operators import topics as tp
from ..session import materialize, scratch_path
from ..sources import files, snapshots, streams, testdata
from ..sources.store import TableStore
from ..streaming import jobs
from . import query
from .fixtures import MESSAGES, METRICS
from .social import _REPORT
from .telemetry import plain, windows_sql

# A backlog comes in as so many files, of bounded size, and is taken in as so many mini-batches.
_LANDED, _FILE_ROWS, _BATCHES = 48, (500, 1_000_000), 6
# Files of a slot came in so many seconds after a first moment, and after the slot before.
_SLOTS, _FIRST, _APART = 6, 1_700_000_000, 7


def _land(rows: DataFrame, path: str, by: str, format: str) -> tuple[str, int]:
    """Write ``rows`` in the order of ``by``, as if the files had come in one after the other.

    Gives the folder and how many files make up a mini-batch.
    """
    spark = rows.sparkSession
    least, most = _FILE_ROWS
    file_rows = min(most, max(least, rows.count() // _LANDED))
    ordered = rows.repartitionByRange(by).sortWithinPartitions(by).drop(by)
    ordered.write.format(format).option("maxRecordsPerFile", file_rows).save(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    landed = sorted((s.getPath() for s in system.listStatus(folder) if s.getPath().getName()[0] not in "_."), key=str)
    for i, file in enumerate(landed):
        system.setTimes(file, 1_700_000_000_000 + 1000 * i, -1)
    return path, -(-len(landed) // _BATCHES)


def _land_slots(rows: DataFrame, path: str, format: str) -> tuple[str, int]:
    """Write the rows of each ``slot`` as files that came in some seconds after those of the slot before.

    Gives the folder and how many files make up a mini-batch.
    """
    spark = rows.sparkSession
    rows.write.format(format).partitionBy("slot").save(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = 0
    for slot in range(_SLOTS):
        part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/slot={slot}")
        for status in system.listStatus(part) if system.exists(part) else ():
            system.setTimes(status.getPath(), 1000 * (_FIRST + _APART * slot), -1)
            files += 1
    return path, -(-files // _BATCHES)


def _landed_slots(lines: DataFrame, path: str, arrival: bool = False) -> DataFrame:
    """Lines as a stream of files whose times are fixed by their ``event_id``."""
    slotted = lines.select("value", (F.col("event_id") % _SLOTS).alias("slot"))
    return streams.text_lines(lines.sparkSession, *_land_slots(slotted, path, "text"), arrival=arrival)


def _landed_lines(spark: SparkSession, sf_dir: str, copies: int = 1, arrival: bool = False) -> DataFrame:
    """The message lines as a stream of files, several mini-batches long, each line ``copies`` times."""
    lines = testdata.message_lines(spark, sf_dir, "ts")
    again = lines.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_n")
    return streams.text_lines(spark, *_land(again, scratch_path(spark, "landing"), "ts", "text"), arrival=arrival)


def _landed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.envelopes(spark, sf_dir, "ts")
    return streams.envelope_files(spark, *_land(rows, scratch_path(spark, "envelopes"), "ts", "parquet"))


@query(_REPORT)
def final_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of mini-batches in the table store, merged on the way, then the report over them."""
    store = jobs.history_store(spark, scratch_path(spark, "store"), relations=False)
    jobs.drain(jobs.topic_history(_landed_lines(spark, sf_dir), store, scratch_path(spark, "progress"), compact_every=4))
    return jobs.history_report(store, 3).as_rows()


@query(f"WITH {MESSAGES} SELECT id, author, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS tweet FROM msg")
def slim_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim messages streamed into a parquet table."""
    out = scratch_path(spark, "slim")
    jobs.drain(jobs.slim_messages(_landed_lines(spark, sf_dir), out, scratch_path(spark, "progress")))
    return spark.read.parquet(out)


@query(f"WITH {METRICS} SELECT g, k, t, v FROM metrics")
def raw_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metric rows streamed into CSV, each exactly once."""
    out = scratch_path(spark, "raw")
    stream = _landed_envelopes(spark, sf_dir)
    jobs.drain(jobs.raw_metrics(stream, out, scratch_path(spark, "progress")))
    return files.read_metric_csv(spark, out)


@query(windows_sql(90_000, 30_000))
def stream_metric_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding averages as a stream keeps them, the last windows included."""
    out = scratch_path(spark, "averages")
    stream = _landed_envelopes(spark, sf_dir)
    jobs.drain(jobs.metric_averages(stream, out, scratch_path(spark, "progress"), running=True))
    return plain(jobs.latest(spark, out, ["window_start", "window_end", "k"], schemas.AVERAGES))


@query(f"SELECT * FROM ({windows_sql(90_000, 30_000)}) QUALIFY window_end = max(window_end) OVER ()")
def stream_latest_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The averages of the newest 90 seconds after a stream has run."""
    out = scratch_path(spark, "latest")
    jobs.drain(jobs.latest_averages(_landed_envelopes(spark, sf_dir), out, scratch_path(spark, "progress")))
    return plain(snapshots.newest(spark, out, schemas.AVERAGES))


@query(f"""WITH {MESSAGES}, tags AS (
  SELECT tag FROM (SELECT unnest(string_split(lower(text), ' ')) AS tag FROM msg) WHERE starts_with(tag, '#'))
SELECT tag, count(*) AS "count" FROM tags GROUP BY tag ORDER BY "count" DESC, tag LIMIT 10""")
def stream_top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top tags of a stream, polled after its last batch."""
    store = jobs.tag_store(spark, scratch_path(spark, "tags"))
    texts = msg.live(msg.parse(_landed_lines(spark, sf_dir, arrival=True))).select(F.col("text").alias("value"), "arrived")
    jobs.drain(jobs.tag_totals(texts, store, scratch_path(spark, "progress"), compact_every=3))
    return jobs.polled_top_tags(store)


@query(f"""WITH {MESSAGES}, tags AS (
  SELECT id % {_SLOTS} AS slot, tag FROM (SELECT id, unnest(string_split(lower(text), ' ')) AS tag FROM msg)
  WHERE starts_with(tag, '#')),
arrived AS (SELECT tag, {_FIRST} + {_APART} * slot AS s FROM tags),
windows AS (SELECT tag, s // 10 * 10 - unnest([0, 10]) AS w FROM arrived)
SELECT make_timestamp(w * 1000000) AS window_start, tag, count(*) AS "count" FROM windows GROUP BY ALL""")
def stream_tags_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags per 20 seconds, every 10 seconds, of the time at which their files came in."""
    lines = _landed_slots(testdata.message_lines(spark, sf_dir, "event_id"), scratch_path(spark, "landing"), arrival=True)
    texts = msg.live(msg.parse(lines)).select(F.col("text").alias("value"), "arrived")
    out = scratch_path(spark, "arrivals")
    jobs.drain(jobs.tags_by_arrival(texts, out, scratch_path(spark, "progress")))
    found = jobs.latest(spark, out, ["window_start", "tag"], schemas.WINDOW_TAGS)
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH {MESSAGES}, held AS (
  SELECT event_id % {_SLOTS} AS slot, event_id % 13 = 0 AS broken, event_id % 7 = 0 AS notice, event_id % 101 = 0 AS untimed
  FROM raw)
SELECT slot AS batch, count(*) AS lines, count(*) FILTER (NOT broken AND NOT notice) AS messages,
       count(*) FILTER (NOT broken AND notice) AS notices, count(*) FILTER (broken) AS unreadable,
       count(*) FILTER (NOT broken AND NOT notice AND untimed) AS untimed FROM held GROUP BY slot""")
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mini-batch held, one line in thirteen being no JSON; a run of the query a batch."""
    lines = testdata.message_lines(spark, sf_dir, "event_id")
    lines = lines.withColumn("value", F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("?"), "value")).otherwise(F.col("value")))
    landing, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    store = TableStore(spark, scratch_path(spark, "store"), {"slim": schemas.SLIM, "intake": schemas.INTAKE})
    for slot in range(_SLOTS):
        lines.where(F.col("event_id") % _SLOTS == slot).select("value").write.mode("append").text(landing)
        jobs.drain(jobs.message_intake(streams.text_lines(spark, landing), store, progress))
    held = store.read("intake", with_batch=True).withColumnRenamed("batch_id", "batch")
    return held.select("batch", *schemas.INTAKE.fieldNames())


@query(f"""WITH {MESSAGES}
SELECT author AS "user", topic, count(*) AS n FROM (
  SELECT author, unnest(tags) AS topic FROM msg WHERE sent IS NOT NULL) GROUP BY ALL""")
def stream_topic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors and topics that come in as two streams in different order, joined on the message."""
    messages = msg.with_time(msg.parse(testdata.message_lines(spark, sf_dir, "event_id"))).where("ts IS NOT NULL")
    messages = materialize(messages.select("id", "user", "entities", "ts", "event_id"), "messages")
    slots = {"user": F.col("event_id") % _SLOTS, "topic": (F.col("event_id") + _SLOTS // 2) % _SLOTS}
    said = {"user": F.col("user.screen_name"), "topic": F.explode("entities.hashtags.text")}
    sides = []
    for name, value in said.items():
        rows = messages.select("id", value.alias(name), "ts", slots[name].alias("slot"))
        path, files_each = _land_slots(rows, scratch_path(spark, name), "parquet")
        schema = f"id bigint, {name} string, ts timestamp"
        sides.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(path).drop("slot"))
    out = scratch_path(spark, "pairs")
    # Slots hold rows of all times, so nothing counts as late here.
    jobs.drain(jobs.topic_users(*sides, out, scratch_path(spark, "progress"), watermark="10000 days"))
    return spark.read.parquet(out).groupBy("user", "topic").agg(F.count("*").alias("n"))


@query(f"WITH {MESSAGES} SELECT id, created_at FROM msg WHERE sent IS NOT NULL")
def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line delivered twice, repeats dropped by id, kept as JSON files."""
    out = scratch_path(spark, "unique")
    unique = jobs.unique_messages(_landed_lines(spark, sf_dir, copies=2)).select("id", "created_at")
    jobs.drain(jobs.file_sink(unique, out, scratch_path(spark, "progress"), "json"))
    return spark.read.schema("id bigint, created_at string").json(out)


@query(f"""WITH {MESSAGES},
per_window AS (SELECT time_bucket(INTERVAL '2 hours', sent) AS window_start, unnest(tags) AS topic FROM msg WHERE sent IS NOT NULL),
sums AS (SELECT window_start, topic, count(*) AS num_tweets FROM per_window GROUP BY ALL),
placed AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY window_start ORDER BY num_tweets DESC, topic) AS INTEGER)
            AS num_tweets_rnk FROM sums)
SELECT * FROM placed WHERE num_tweets_rnk <= 3""")
def stream_top_topics_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows counted by a stream, ranked when they are read."""
    out = scratch_path(spark, "windows")
    jobs.drain(jobs.topic_windows(_landed_lines(spark, sf_dir), out, scratch_path(spark, "progress"), running=True))
    top = tp.rank_windows(jobs.latest(spark, out, ["window_start", "topic"], schemas.WINDOW_TOPICS), 3)
    return top.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))

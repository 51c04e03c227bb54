"""Streaming jobs. Each takes a streaming DataFrame, so any source will do."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Future
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from .. import schemas
from ..operators import messages as msg
from ..operators import metrics as mt
from ..operators import topics as tp
from ..operators import words as wd
from ..plans import topic_report
from ..sources import snapshots
from ..sources.store import TableStore
from .idle import totals

WATERMARK = "10 minutes"


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start with a checkpoint: every ``interval``, or once over all that is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_for(query: StreamingQuery, seconds: int) -> None:
    """Let a query run for a while, let it finish its batch, then stop it; the session stays usable."""
    if not query.awaitTermination(seconds):
        while query.isActive and query.status["isTriggerActive"]:
            time.sleep(0.05)
        query.stop()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query to take in everything."""
    query.awaitTermination()
    return query


IntervalSink = Callable[[topic_report.TopicReport, int], None]


#: Tables of a topic history: the report's states, and the raw relations for those who want them.
STATES = {"topic_counts": schemas.TOPIC_COUNTS, "user_topics": schemas.USER_TOPICS, "mention_topics": schemas.MENTION_TOPICS}
RELATIONS = {"topics": schemas.TOPICS, "users": schemas.USERS, "mentions": schemas.MENTIONS, "deleted": schemas.DELETED}


def history_store(spark: SparkSession, root: str, relations: bool = True) -> TableStore:
    """A store for :func:`topic_history`: states that merge, and relations whose deleted ids can be left out."""
    if not relations:
        return TableStore(spark, root, STATES, merges=topic_report.MERGES)
    merges = topic_report.MERGES | {"deleted": lambda df: df.distinct()}
    return TableStore(spark, root, STATES | RELATIONS, merges=merges, tombstones="deleted")


def topic_history(
    lines: DataFrame,
    store: TableStore,
    checkpoint: str,
    n: int = 3,
    on_interval: IntervalSink | None = None,
    interval: str | None = None,
    compact_every: int = 16,
) -> StreamingQuery:
    """Append what each mini-batch holds to those of STATES and RELATIONS that the store has.

    ``on_interval`` gets the topic report of the mini-batch. A batch is stored under the
    id that the checkpoint keeps for the query and its number: a replayed batch replaces
    itself, a query with another checkpoint adds to the history. Every ``compact_every``
    batches the closed ones are merged. An error ends the query.
    """
    identity: Future[str] = Future()

    def take(batch: DataFrame, batch_id: int) -> None:
        query_id = identity.result()
        messages = msg.parse(batch).select("id", "user", "entities", "delete").persist()
        try:
            frames = {"topics": msg.topics(messages), "users": msg.users(messages), "mentions": msg.mentions(messages)}
            frames |= {"deleted": msg.deleted_ids(messages)} | topic_report.partial_states(messages)
            store.write_batches({name: df for name, df in frames.items() if name in store.tables}, query_id, batch_id)
            if on_interval:
                on_interval(topic_report.from_messages(messages, n), batch_id)
        finally:
            messages.unpersist()
        if batch_id % compact_every == compact_every - 1:
            store.compact_all({query_id: batch_id})

    query = start(lines.writeStream.foreachBatch(take), checkpoint, interval)
    identity.set_result(str(query.id))
    return query


def history_report(store: TableStore, n: int = 3, live: bool = False) -> topic_report.TopicReport:
    """The final report over everything the store has accumulated.

    It comes from the merged states where the store keeps them. ``live`` leaves out messages
    that were deleted; states can't tell those, so the relations are read.
    """
    if not live and STATES.keys() <= store.tables.keys():
        return topic_report.from_states(*(store.read(name) for name in STATES), n)
    return topic_report.from_relations(*(store.read(name, live=live) for name in ("topics", "users", "mentions")), n)


def _timed(lines: DataFrame, watermark: str) -> DataFrame:
    """Live messages with a readable time; ``msg.unreadable_times`` counts the others."""
    timed = msg.with_time(msg.live(msg.parse(lines))).where(F.col("ts").isNotNull())
    return timed.withWatermark("ts", watermark)


def topic_windows(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "2 hours",
    watermark: str = WATERMARK,
    interval: str | None = None,
    running: bool = False,
) -> StreamingQuery:
    """Topic counts of closed windows, as a table for :func:`.topics.rank_windows`.

    Spark does not rank inside a stream; the windows are ranked on read. ``running``
    writes all windows as they change, for :func:`latest`.
    """
    counts = tp.windowed_counts(_timed(lines, watermark), window)
    keys = ["window_start", "topic"]
    return updates(counts, path, checkpoint, keys, interval) if running else file_sink(counts, path, checkpoint, "parquet", interval)


def commentators(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "2 hours",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """Topic and commentator pairs of closed windows, for :func:`.topics.top_commentators`."""
    pairs = tp.commentator_pairs(_timed(lines, watermark), window)
    return file_sink(pairs, path, checkpoint, "parquet", interval)


def slim_messages(lines: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """(id, author, tweet) of every live message, appended as parquet."""
    slim = msg.slim(msg.parse(lines))
    return start(slim.writeStream.format("parquet").option("path", path), checkpoint, interval)


def unique_messages(lines: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Live messages with repeats of an id dropped within the watermark."""
    return _timed(lines, watermark).dropDuplicatesWithinWatermark(["id"])


def file_sink(
    df: DataFrame, path: str, checkpoint: str, format: str = "json", interval: str | None = None
) -> StreamingQuery:
    """Append any stream as JSON, text, CSV or parquet files."""
    return start(df.writeStream.format(format).option("path", path), checkpoint, interval)


def raw_metrics(envelopes: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Every metric row once, as CSV, before any windowing."""
    rows = mt.metric_rows(envelopes).select("g", "k", "t", "v")
    return file_sink(rows, path, checkpoint, "csv", interval)


def metric_averages(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "90 seconds",
    slide: str | None = "30 seconds",
    watermark: str = WATERMARK,
    epoch_offset_ms: int = 0,
    interval: str | None = None,
    running: bool = False,
) -> StreamingQuery:
    """Window averages, each written once its window is closed by the watermark.

    ``running`` writes all windows as they change, for :func:`latest`.
    """
    rows = mt.with_time(mt.metric_rows(envelopes), epoch_offset_ms).withWatermark("ts", watermark)
    averages = mt.windowed_average(rows, size, slide)
    if running:
        return updates(averages, path, checkpoint, ["window_start", "window_end", "k"], interval)
    return file_sink(averages, path, checkpoint, "parquet", interval)


def metric_sums(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "1 minute",
    watermark: str = WATERMARK,
    epoch_offset_ms: int = 0,
    interval: str | None = None,
) -> StreamingQuery:
    """Sums per metric of closed windows."""
    rows = mt.with_time(mt.metric_rows(envelopes), epoch_offset_ms).withWatermark("ts", watermark)
    return file_sink(mt.windowed_sum(rows, size), path, checkpoint, "parquet", interval)


def latest_averages(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "90 seconds",
    slide: str | None = "30 seconds",
    watermark: str = WATERMARK,
    epoch_offset_ms: int = 0,
    interval: str | None = None,
) -> StreamingQuery:
    """Averages of the newest window, a new snapshot whenever it changes (``snapshots.newest``)."""
    rows = mt.with_time(mt.metric_rows(envelopes), epoch_offset_ms).withWatermark("ts", watermark)
    windows = mt.windowed_average(rows, size, slide)

    def take(batch: DataFrame, batch_id: int) -> None:
        # A batch brings every metric of a window that it changes, but not those it leaves.
        batch = batch.persist()
        try:
            before = snapshots.newest(batch.sparkSession, path, batch.schema, below=batch_id)
            both = batch.withColumn("_old", F.lit(0)).unionByName(before.withColumn("_old", F.lit(1)))
            last = both.agg(F.max("window_end").alias("_last"))
            latest = both.join(last, F.col("window_end") == F.col("_last")).drop("_last")
            first = F.row_number().over(Window.partitionBy("k").orderBy("_old"))
            snapshots.write(latest.withColumn("_n", first).where("_n = 1").drop("_n", "_old"), path, batch_id)
        finally:
            batch.unpersist()

    return start(windows.writeStream.outputMode("update").foreachBatch(take), checkpoint, interval)


def tag_store(spark: SparkSession, root: str) -> TableStore:
    """A store for :func:`tag_totals`: the newest total of each tag that has not left."""

    def newest(df: DataFrame) -> DataFrame:
        last = df.groupBy("tag").agg(F.max_by(F.struct("count", "batch"), "batch").alias("_row"))
        return last.select("tag", "_row.*")

    tables, known = {"tags": schemas.TAG_TOTALS}, {"tags": lambda df: df.where("count IS NOT NULL")}
    # Each compaction takes in the whole table, which holds live tags alone, so tags that left go.
    return TableStore(spark, root, tables, merges={"tags": newest}, settled=known, fan=1)


def tag_totals(
    lines: DataFrame,
    store: TableStore,
    checkpoint: str,
    idle: timedelta = timedelta(days=7),
    watermark: str = "1 minute",
    interval: str | None = None,
    compact_every: int = 16,
) -> StreamingQuery:
    """Running totals of the tags of lines (value, arrived), for :func:`polled_top_tags`.

    A tag that no line has brought for ``idle`` of arrival time leaves the state and the
    store, so both hold what is alive however long the stream runs. A batch writes the
    totals that it changes. One query writes to a store.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        totals = batch.select(F.col("key").alias("tag"), F.col("total").alias("count"), F.lit(batch_id).alias("batch"))
        store.write_batch(totals, "tags", "tags", batch_id)
        if batch_id % compact_every == compact_every - 1:
            store.compact("tags", current={"tags": batch_id})

    tags = wd.hashtag_tokens(lines, keep=["arrived"]).select(F.col("tag").alias("key"), F.col("arrived").alias("seen"))
    changed = totals(tags, int(idle.total_seconds() * 1000), watermark)
    return start(changed.writeStream.outputMode("update").foreachBatch(take), checkpoint, interval)


def polled_top_tags(store: TableStore, n: int = 10) -> DataFrame:
    """The top tags as of the last batch."""
    return wd.top_tags(store.read("tags").select("tag", "count"), n)


def tags_by_arrival(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "20 seconds",
    slide: str = "10 seconds",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """Tag counts per sliding window of the time at which lines (value, arrived) came in.

    Windows are written as they change; :func:`latest` has them as they are now.
    """
    timed = lines.withColumnRenamed("arrived", "ts").withWatermark("ts", watermark)
    counts = wd.tags_sliding(timed, "value", size, slide)
    return updates(counts, path, checkpoint, ["window_start", "tag"], interval)


def intake_measures() -> list[Column]:
    """What :data:`.schemas.INTAKE` counts of parsed messages that carry ``ts``."""
    live, notice = F.col("id").isNotNull(), F.col("delete.status.id").isNotNull()
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(live).alias("messages"),
        F.count_if(~live & notice).alias("notices"),
        F.count_if(~live & ~notice).alias("unreadable"),
        F.count_if(live & F.col("ts").isNull()).alias("untimed"),
    ]


def message_intake(
    lines: DataFrame, store: TableStore, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Slim messages of each batch into table ``slim``, and what the batch held into ``intake``.

    The counts are taken while the batch is written, in the same pass.
    """
    identity: Future[str] = Future()

    def take(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        slim = msg.slim(msg.with_time(msg.parse(batch)).observe(counts, *intake_measures()))
        store.write_batch(slim, "slim", identity.result(), batch_id)
        held = [counts.get[name] for name in schemas.INTAKE.fieldNames()]
        row = batch.sparkSession.createDataFrame([held], schemas.INTAKE)
        store.write_batch(row, "intake", identity.result(), batch_id)

    query = start(lines.writeStream.foreachBatch(take), checkpoint, interval)
    identity.set_result(str(query.id))
    return query


def topic_users(
    users: DataFrame,
    topics: DataFrame,
    path: str,
    checkpoint: str,
    apart: str = "10 minutes",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """(user, topic, ts) of authors (id, user, ts) and topics (id, topic, ts) that come in apart.

    A pair has one id and times at most ``apart`` from each other. Each side waits for the
    other until the watermark says that nothing in reach can come any more; rows
    later than that are left out.
    """
    authors = users.select("id", "user", F.col("ts").alias("user_ts")).withWatermark("user_ts", watermark)
    tagged = topics.select(F.col("id").alias("topic_id"), "topic", "ts").withWatermark("ts", watermark)
    near = f"ts BETWEEN user_ts - INTERVAL {apart} AND user_ts + INTERVAL {apart}"
    pairs = authors.join(tagged, (F.col("id") == F.col("topic_id")) & F.expr(near))
    return file_sink(pairs.select("user", "topic", "ts"), path, checkpoint, "parquet", interval)


def tags_sliding(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "20 seconds",
    slide: str = "10 seconds",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """Tag counts per sliding window of the messages' own time."""
    tags = wd.tags_sliding(_timed(lines, watermark), "text", size, slide)
    return file_sink(tags, path, checkpoint, "parquet", interval)


def _update_store(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> TableStore:
    """A store of the newest row of each group, with the number of the batch that gave it."""
    values = [c for c in schema.fieldNames() if c not in keys]

    def newest(df: DataFrame) -> DataFrame:
        last = df.groupBy(*keys).agg(F.max_by(F.struct(*values, "_batch"), "_batch").alias("_row"))
        return last.select(*keys, "_row.*")

    full = T.StructType([schema[k] for k in keys] + [schema[c] for c in values] + [T.StructField("_batch", T.LongType())])
    return TableStore(spark, path, {"updates": full}, merges={"updates": newest})


def updates(
    groups: DataFrame, path: str, checkpoint: str, keys: list[str], interval: str | None = None, compact_every: int = 16
) -> StreamingQuery:
    """Write the groups that each batch changes, open windows too; :func:`latest` reads them.

    Every ``compact_every`` batches older rows of a group are merged away.
    """
    store = _update_store(groups.sparkSession, path, groups.schema, keys)

    def take(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch.withColumn("_batch", F.lit(batch_id).cast("bigint")), "updates", "updates", batch_id)
        if batch_id % compact_every == compact_every - 1:
            store.compact("updates", current={"updates": batch_id})

    return start(groups.writeStream.outputMode("update").foreachBatch(take), checkpoint, interval)


def latest(spark: SparkSession, path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """The newest row of every group that :func:`updates` has written; none before its first batch."""
    return _update_store(spark, path, schema, keys).read("updates").drop("_batch")


def word_counts(lines: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Running word counts; ``latest(spark, path, ["word"], schemas.WORD_COUNTS)`` has the newest of each word."""
    return updates(wd.word_count(lines), path, checkpoint, ["word"], interval)


def console(df: DataFrame, checkpoint: str, rows: int = 50, interval: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return start(writer, checkpoint, interval)


def to_pandas(df: DataFrame, rows: int):
    """A small result as pandas; ``rows`` bounds what reaches the driver."""
    return df.limit(rows).toPandas()


class InputRows(StreamingQueryListener):
    """Records taken in, by query; add it with ``spark.streams.addListener`` before the query starts.

    It hears of every mini-batch, while a query itself remembers its last hundred only.
    """

    def __init__(self):
        self.batches: dict[str, dict[int, int]] = {}
        self.ended: set[str] = set()

    def rows(self, query: StreamingQuery) -> int:
        """Records of all batches of a query so far; waits for the last report of an ended one."""
        while not query.isActive and str(query.runId) not in self.ended:
            time.sleep(0.05)
        return sum(self.batches.get(str(query.id), {}).values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.batches.setdefault(str(progress.id), {})[progress.batchId] = progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

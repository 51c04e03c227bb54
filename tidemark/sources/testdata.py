"""Mappings from the supplied tables to the record kinds of this package.

The supplied tables hold no social or device messages, so these functions
derive them, row by row and whole table to whole table, in the form they would
arrive in: JSON text, binary bodies, tab separated lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records

_FILES = 100  # corpus files
_TASK_BYTES = 1 << 23  # text of a task that writes corpus files; its lines are sorted in memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").withColumn("kk", k)


def message_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """One JSON line per event: ``value STRING``, and the event's columns in ``keep``.

    Hashtags are the event type and ``k<k>``, the latter given twice on every
    eleventh event; every third event mentions nobody and every seventh is a
    delete notice, so repeats, empty lists and tombstones all occur.
    """
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    mention = F.concat(F.lit("u"), ((F.col("user_id") + F.col("kk")) % 150).cast("string"))
    tag = F.concat(F.lit("k"), F.col("kk").cast("string"))
    shown = F.when(F.col("user_id") % 2 == 1, F.upper("event_type")).otherwise(F.col("event_type"))
    text = F.concat(
        F.lit(" #"), shown, F.lit(" #"), tag, F.lit(" @"), mention, F.lit(" hello  world\r\n")
    )

    def named(field: str, value: Column) -> Column:
        return F.struct(value.alias(field))

    # The form of the feed, and a few texts that are no time.
    feed = F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    created = F.when(F.col("event_id") % 101 == 0, "soon").otherwise(feed)
    hashtags = F.when(
        F.col("event_id") % 11 == 0, F.array(*[named("text", t) for t in (F.col("event_type"), tag, tag)])
    ).otherwise(F.array(named("text", F.col("event_type")), named("text", tag)))
    nobody = F.array().cast("array<struct<screen_name:string>>")
    mentions = F.when(F.col("event_id") % 3 == 0, nobody).otherwise(F.array(named("screen_name", mention)))
    message = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            created.alias("created_at"),
            text.alias("text"),
            F.struct(user.alias("screen_name")).alias("user"),
            F.struct(hashtags.alias("hashtags"), mentions.alias("user_mentions")).alias("entities"),
        )
    )
    status = F.struct(F.col("event_id").alias("id"), F.col("event_id").cast("string").alias("id_str"))
    tombstone = F.to_json(F.struct(F.struct(status.alias("status")).alias("delete")))
    is_tombstone = F.col("event_id") % 7 == 0
    return _events(spark, sf_dir).select(F.when(is_tombstone, tombstone).otherwise(message).alias("value"), *keep)


def envelopes(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """One device event per row of ``events``: two metrics in a JSON body.

    The first metric is the event type with its value, text that is no number
    on some rows; the second is ``<event type>_k`` with the event's ``k``.
    """
    group = F.when(F.col("user_id") % 2 == 0, "Fast_1s").otherwise("Medium_30s")
    value = F.when(F.col("event_id") % 97 == 0, "bad").otherwise(F.col("value").cast("string"))
    t = F.unix_millis(F.col("ts").cast("timestamp"))

    def metric(k: Column, v: Column) -> Column:
        return F.struct(group.alias("g"), k.alias("k"), v.alias("v"), t.alias("t"))

    data = F.array(
        metric(F.col("event_type"), value),
        metric(F.concat("event_type", F.lit("_k")), F.col("kk").cast("string")),
    )
    body = F.concat(F.to_json(F.struct(data.alias("Data"))), F.lit("\r\n"))
    source = F.concat(F.lit("device-"), F.col("user_id").cast("string"))
    return _events(spark, sf_dir).select(
        records.to_bytes(body).alias("body"),
        F.create_map(F.lit("content-type"), F.lit("application/json"), F.lit("source"), source).alias("properties"),
        *keep,
    )


def broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, value`` pairs whose value is a satellite report of one event."""
    topic = F.concat(
        F.lit("/applications/in/"),
        F.col("user_id").cast("string"),
        F.when(F.col("kk") % 2 == 0, "/public/").otherwise("/private/"),
        F.col("event_type"),
    )
    satellites = F.transform(
        F.array(F.lit(0), F.lit(1)),
        lambda i: F.struct(
            (F.col("user_id") + i).cast("int").alias("PRN"),
            F.col("kk").cast("int").alias("el"),
            ((F.col("user_id") * 2 + i) % 360).cast("int").alias("az"),
            (F.col("kk") % 40 * i).cast("int").alias("ss"),
            (F.col("kk") % 40 * i > 0).alias("used"),
        ),
    )
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    value = F.to_json(F.struct(t.alias("t"), satellites.alias("d")))
    return _events(spark, sf_dir).select(topic.alias("topic"), value.alias("value"))


def _by_file(texts: DataFrame) -> DataFrame:
    """Texts dealt to tasks of some ``_TASK_BYTES``, those of a file number to few of them."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = 1 + size // _TASK_BYTES
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 + tasks // _FILES))
    return texts.repartition(tasks, F.col("doc_id") % _FILES, share)


def ngrams(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """Every pair of neighbouring words of every document as one bigram line.

    ``file_no`` plays the corpus file; (doc_id, pos) is the line order in it. With
    ``by_file`` the lines of a file come from few tasks: the texts are moved for that, and
    not their lines, which take many times the room.
    """
    texts = documents(spark, sf_dir, "doc_id", "text")
    # Split in a step of its own: the generator below uses the list three times.
    split = (_by_file(texts) if by_file else texts).select("doc_id", F.split("text", "[ \t\r\n]").alias("ws"))
    pairs = F.arrays_zip(F.col("ws").alias("w1"), F.slice("ws", F.lit(2), F.size("ws")).alias("w2"))
    return (
        split.select("doc_id", F.posexplode(pairs).alias("pos", "pair"))
        .select("doc_id", "pos", "pair.w1", "pair.w2")
        .where(F.col("w2").isNotNull())
        .select(
            (F.col("doc_id") % _FILES).cast("int").alias("file_no"),
            "doc_id",
            "pos",
            F.concat_ws(" ", "w1", "w2").alias("bi_gram"),
            (1900 + F.col("doc_id") % 100).cast("int").alias("year"),
            (1 + F.length("w1") % 5).cast("bigint").alias("match_count"),
            F.lit(1).cast("bigint").alias("page_count"),
            F.lit(1).cast("bigint").alias("volume_count"),
        )
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One walk per document, from its first run of ASCII letters."""
    word = F.regexp_extract("text", "[A-Za-z]+", 0)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("walk_id"), word.alias("word"))


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as quality-sensor records, before their columns are named."""
    gap = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("a"),
        F.col("l_linenumber").alias("b"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("c"),
        F.col("l_quantity").alias("d"),
        F.col("l_extendedprice").alias("e"),
        gap.alias("f"),
    )

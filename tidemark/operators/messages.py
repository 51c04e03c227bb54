"""Social messages: parsing, live filter, relations, projections, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import draws, records, text

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEED_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to message columns. Text that is no message gives NULLs.

    The schema is fixed, so a batch that lacks a field yields a NULL column
    and an empty relation, never an error or another batch's rows. The record
    is unpacked by a generator because filters on its fields would otherwise
    be pushed below the projection and parse the text a second time.
    """
    rest = [c for c in lines.columns if c != column]
    return lines.select(*rest, F.inline(F.array(F.from_json(column, schemas.MESSAGE))))


def live(messages: DataFrame) -> DataFrame:
    """Drop tombstones and anything else without an id."""
    return messages.where(F.col("id").isNotNull())


def deleted_ids(messages: DataFrame) -> DataFrame:
    gone = messages.select(F.col("delete.status.id").alias("id"))
    return gone.where(F.col("id").isNotNull()).distinct()


def apply_deletes(relation: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Take deleted messages out of a stored relation. Not done by default.

    Ids parsed from text are many more than the size of the file under them tells the
    planner, so they are dealt out with the relation and never sent whole to every task.
    """
    return relation.join(deleted_ids(tombstones).hint("merge"), "id", "left_anti")


def with_time(messages: DataFrame, name: str = "ts") -> DataFrame:
    """Event time from ``created_at``, in the feed's form or the plain one.

    The feed writes ``Tue Nov 28 07:52:11 +0000 2017``. A text in neither form gives
    NULL, which no window takes in; :func:`unreadable_times` counts such messages.
    """
    # The day of the week says nothing new, and the parser takes none.
    feed = F.try_to_timestamp(F.substring("created_at", 5, 40), F.lit(FEED_FORMAT))
    plain = F.try_to_timestamp("created_at", F.lit(TIME_FORMAT))
    return messages.withColumn(name, F.coalesce(feed, plain))


def unreadable_times(messages: DataFrame) -> DataFrame:
    """One row: live messages, and how many of them have no readable time."""
    missing = F.count_if(F.col("ts").isNull())
    return with_time(live(messages)).agg(F.count("*").alias("messages"), missing.alias("unreadable"))


def topics(messages: DataFrame) -> DataFrame:
    """(id, topic), one row per hashtag occurrence."""
    return live(messages).select("id", F.explode("entities.hashtags.text").alias("topic"))


def users(messages: DataFrame) -> DataFrame:
    """(id, user), one row per message."""
    return live(messages).select("id", F.col("user.screen_name").alias("user"))


def mentions(messages: DataFrame) -> DataFrame:
    """(id, mention), one row per mentioned name."""
    return live(messages).select("id", F.explode("entities.user_mentions.screen_name").alias("mention"))


def wide(messages: DataFrame) -> DataFrame:
    """id, user, topic, mention side by side, NULL where a list is empty.

    The lists sit in one row, so this needs no join and no shuffle.
    """
    return (
        live(messages)
        .select(
            "id",
            F.col("user.screen_name").alias("user"),
            F.col("entities.user_mentions.screen_name").alias("_mentions"),
            F.explode_outer("entities.hashtags.text").alias("topic"),
        )
        .select("id", "user", "topic", F.explode_outer("_mentions").alias("mention"))
    )


def people(messages: DataFrame) -> DataFrame:
    """(id, people): the author followed by everybody mentioned."""
    author = F.array(F.col("user.screen_name"))
    named = F.coalesce(F.col("entities.user_mentions.screen_name"), F.array().cast("array<string>"))
    return live(messages).select("id", F.concat(author, named).alias("people"))


def simple(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """The flattened record: id, user, mentions, topics, timestamp, text.

    The time stamp is the processing time unless a clock column is given.
    """
    none = F.array().cast("array<string>")
    return live(messages).select(
        "id",
        F.col("user.screen_name").alias("user"),
        F.coalesce(F.col("entities.user_mentions.screen_name"), none).alias("mentions"),
        F.coalesce(F.col("entities.hashtags.text"), none).alias("topics"),
        F.date_format(F.current_timestamp() if clock is None else clock, TIME_FORMAT).alias("timestamp"),
        "text",
    )


def slim(messages: DataFrame) -> DataFrame:
    """(id, author, tweet) with the text trimmed."""
    return live(messages).select(
        "id", F.col("user.screen_name").alias("author"), text.trim_space(F.col("text")).alias("tweet")
    )


def id_and_time(messages: DataFrame) -> DataFrame:
    return live(messages).select("id", "created_at")


def json_id(lines: DataFrame, column: str = "value") -> DataFrame:
    """The id straight from the JSON text, without parsing the rest."""
    return lines.select(F.get_json_object(column, "$.id").try_cast("bigint").alias("id"))


def user_or_default(messages: DataFrame, default: str = "unknown") -> DataFrame:
    return messages.select("id", records.field_or(F.col("user.screen_name"), default).alias("user"))


def user_counts(messages: DataFrame) -> DataFrame:
    """Messages per author; messages without one count under the empty name."""
    return messages.groupBy(records.field_or(F.col("user.screen_name")).alias("user")).agg(
        F.count("*").alias("num_tweets")
    )


def sample(messages: DataFrame, one_in: int) -> DataFrame:
    """A repeatable sample of the live messages, by hash of the id."""
    return live(messages).where(draws.in_sample(F.col("id"), one_in))

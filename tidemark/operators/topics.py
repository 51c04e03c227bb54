"""Topic counts, ranking, and who is connected with the top topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from . import messages as msg

# Pieces into which the people of one hot topic are cut.
_PIECES = 32


def topic_counts(topics: DataFrame, distinct_messages: bool = False) -> DataFrame:
    """(topic, num_tweets): occurrences, or distinct messages on request."""
    n = F.count_distinct("id") if distinct_messages else F.count("*")
    return topics.groupBy("topic").agg(n.alias("num_tweets"))


def by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("num_tweets"), "topic")


def top_topics(counts: DataFrame, n: int = 3) -> DataFrame:
    """The N most frequent topics with their dense rank.

    A topic occurs once in ``counts``, so rank and row number agree and the
    ranking only has to look at N rows, chosen by a distributed top-k.
    """
    best = by_count(counts).limit(n)
    rank = F.dense_rank().over(Window.orderBy(F.desc("num_tweets"), "topic"))
    return best.select("topic", "num_tweets", rank.alias("num_tweets_rnk"))


def windowed_counts(timed: DataFrame, window: str = "2 hours") -> DataFrame:
    """(window_start, topic, num_tweets) of live messages that carry ``ts``.

    Also runs on a stream whose ``ts`` has a watermark.
    """
    return (
        timed.select("ts", F.explode("entities.hashtags.text").alias("topic"))
        .groupBy(F.window("ts", window).alias("_w"), "topic")
        .agg(F.count("*").alias("num_tweets"))
        .select(F.col("_w.start").alias("window_start"), "topic", "num_tweets")
    )


def rank_windows(counts: DataFrame, n: int = 3) -> DataFrame:
    """The N most frequent topics of every window, with their rank.

    The rank limit is applied before the shuffle and once more within parts of a
    window's topics, so the last step meets at most N rows a part.
    """
    best = [F.desc("num_tweets"), "topic"]
    part = F.spark_partition_id() % _PIECES
    of_part = F.row_number().over(Window.partitionBy("window_start", "_part").orderBy(*best))
    few = counts.withColumn("_part", part).withColumn("_n", of_part).where(F.col("_n") <= n).drop("_n", "_part")
    rank = F.dense_rank().over(Window.partitionBy("window_start").orderBy(*best))
    return few.withColumn("num_tweets_rnk", rank).where(F.col("num_tweets_rnk") <= n)


def top_topics_per_window(messages: DataFrame, n: int = 3, window: str = "2 hours") -> DataFrame:
    """The N most frequent topics of every event-time window."""
    return rank_windows(windowed_counts(msg.with_time(msg.live(messages)), window), n)


def topic_users(users: DataFrame, topics: DataFrame) -> DataFrame:
    """Authors joined with topics on the message id, as (user, topic, n).

    Both sides are counted per message first, so copies of a message multiply
    as numbers and not as rows. Adaptive execution can split a hot id here too.
    """
    left = users.groupBy("id", "user").agg(F.count("*").alias("_u"))
    right = topics.groupBy("id", "topic").agg(F.count("*").alias("_t"))
    return left.join(right, "id").groupBy("user", "topic").agg(F.sum(F.col("_u") * F.col("_t")).alias("n"))


def _restrict(rows: DataFrame, top: DataFrame) -> DataFrame:
    return rows.join(top.select("topic"), "topic", "left_semi")


def _topic_sets(pairs: DataFrame, who: str) -> DataFrame:
    """One sorted set per name; a set holds at most the N top topics."""
    return pairs.groupBy(who).agg(F.sort_array(F.collect_set("topic")).alias(f"top_topics_of_{who}"))


def top_topic_names(names: DataFrame, topics: DataFrame, top: DataFrame, n: int, who: str) -> DataFrame:
    """Who goes with the top topics, from stored relations joined on id.

    ``names`` is the users or the mentions relation and ``who`` its name
    column. Copies are merged on both sides before the join, and a message
    brings at most N topics. Both sides reach the join straight from a
    shuffle, so adaptive execution can split an id that many rows share.
    """
    tagged = _restrict(topics, top).select("id", "topic").distinct()
    pairs = names.select("id", who).distinct().join(tagged, "id")
    return _topic_sets(pairs, who)


def names_of(pairs: DataFrame, top: DataFrame, who: str) -> DataFrame:
    """Who goes with the top topics, from (topic, name) pairs."""
    return _topic_sets(_restrict(pairs, top), who)


def top_topic_users(messages: DataFrame, top: DataFrame, n: int) -> DataFrame:
    """Authors of the top topics straight from messages: no join on id."""
    pairs = msg.live(messages).select(
        F.col("user.screen_name").alias("user"),
        F.explode(F.array_distinct("entities.hashtags.text")).alias("topic"),
    )
    return _topic_sets(_restrict(pairs, top), "user")


def top_topic_mentions(messages: DataFrame, top: DataFrame, n: int) -> DataFrame:
    """Names mentioned with the top topics straight from messages."""
    tagged = msg.live(messages).select(
        F.col("entities.user_mentions.screen_name").alias("_names"),
        F.explode(F.array_distinct("entities.hashtags.text")).alias("topic"),
    )
    pairs = _restrict(tagged, top).select(F.explode(F.array_distinct("_names")).alias("mention"), "topic")
    return _topic_sets(pairs, "mention")


def _tokens_with(text: Column, mark: str) -> Column:
    return F.filter(F.split(text, " "), lambda w: F.startswith(w, F.lit(mark)))


def commentator_pairs(timed: DataFrame, window: str = "2 hours") -> DataFrame:
    """(window_start, topic, commentator, written) of live messages that carry ``ts``.

    Topics are the ``#`` words of the text; commentators are the author and
    the ``@`` words. ``written`` counts the occurrences of the topic that the
    commentator wrote. Also runs on a stream whose ``ts`` has a watermark.
    """
    tagged = timed.select(
        "ts",
        F.concat(F.array(F.col("user.screen_name")), _tokens_with(F.col("text"), "@")).alias("_people"),
        F.explode(_tokens_with(F.col("text"), "#")).alias("topic"),
    )
    # The author stands first in the list.
    people = tagged.select("ts", "topic", F.posexplode("_people").alias("_pos", "commentator"))
    return (
        people.groupBy(F.window("ts", window).alias("_w"), "topic", "commentator")
        .agg(F.sum((F.col("_pos") == 0).cast("bigint")).alias("written"))
        .select(F.col("_w.start").alias("window_start"), "topic", "commentator", "written")
    )


def top_commentators(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The pairs of the N most frequent topics of every window.

    Authors add up to a topic's occurrences, ``num_tweets``. Commentators come
    as one row each, because the list of a hot topic has no bound. The pairs
    are stored, as they are ranked and joined.
    """
    keys = ["window_start", "topic"]
    pairs = materialize(pairs, "pairs")
    counts = pairs.groupBy(*keys).agg(F.sum("written").alias("num_tweets"))
    top = rank_windows(counts, n).drop("num_tweets_rnk")
    # A hot topic's people are cut into pieces by name, each with its own copy of the count.
    part = F.pmod(F.xxhash64("commentator"), F.lit(_PIECES)).cast("int")
    pieces = top.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PIECES - 1))))
    return pairs.withColumn("_part", part).join(pieces, [*keys, "_part"]).drop("_part")


def topic_commentators(messages: DataFrame, n: int = 10, window: str = "2 hours") -> DataFrame:
    """The N most frequent text topics of every window and who took part."""
    return top_commentators(commentator_pairs(msg.with_time(msg.live(messages)), window), n)

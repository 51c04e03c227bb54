"""The topic report: top topics, their authors, and who was mentioned with them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import messages as msg
from ..operators import topics as tp
from ..session import materialize


class TopicReport(NamedTuple):
    top: DataFrame
    users: DataFrame
    mentions: DataFrame

    def ordered(self) -> TopicReport:
        """The three frames sorted for display."""
        return TopicReport(
            self.top.orderBy("num_tweets_rnk"), self.users.orderBy("user"), self.mentions.orderBy("mention")
        )

    def show(self, rows: int = 50) -> None:
        for frame in self.ordered():
            frame.show(n=rows, truncate=False)

    def as_rows(self) -> DataFrame:
        """All three as (part, name, num_tweets, num_tweets_rnk, topics)."""
        none = F.lit(None)

        def sets(frame: DataFrame, who: str) -> DataFrame:
            return frame.select(
                F.lit(who).alias("part"),
                F.col(who).alias("name"),
                none.cast("bigint").alias("num_tweets"),
                none.cast("int").alias("num_tweets_rnk"),
                F.array_join(f"top_topics_of_{who}", ",").alias("topics"),
            )

        top = self.top.select(
            F.lit("topic").alias("part"),
            F.col("topic").alias("name"),
            "num_tweets",
            "num_tweets_rnk",
            none.cast("string").alias("topics"),
        )
        return top.unionByName(sets(self.users, "user")).unionByName(sets(self.mentions, "mention"))


def from_relations(topics: DataFrame, users: DataFrame, mentions: DataFrame, n: int = 3) -> TopicReport:
    """The report over stored relations, whether one interval or all history."""
    top = tp.top_topics(tp.topic_counts(topics), n)
    return TopicReport(
        top,
        tp.top_topic_names(users, topics, top, n, "user"),
        tp.top_topic_names(mentions, topics, top, n, "mention"),
    )


def prepare(messages: DataFrame) -> DataFrame:
    """The few fields the report needs, written once.

    The report passes over its input three times. For a large batch it is
    cheaper to parse once and to read back the small part that matters.
    """
    return materialize(msg.live(messages).select("id", "user", "entities"), "messages")


def from_messages(messages: DataFrame, n: int = 3) -> TopicReport:
    """The same report while the messages are at hand: nothing is joined on id.

    Equal to :func:`from_relations` as long as an id stands for one message;
    copies of a message do no harm. ``messages`` should be persisted or come
    from :func:`prepare`.
    """
    top = tp.top_topics(tp.topic_counts(msg.topics(messages)), n)
    return TopicReport(top, tp.top_topic_users(messages, top, n), tp.top_topic_mentions(messages, top, n))


def partial_states(messages: DataFrame) -> dict[str, DataFrame]:
    """What one mini-batch adds to the report over all history: counts, and who goes with which topic.

    States of several batches are put together by :data:`MERGES`.
    """
    pairs = F.explode(F.array_distinct("entities.hashtags.text")).alias("topic")
    users = msg.live(messages).select(pairs, F.col("user.screen_name").alias("user"))
    names = F.col("entities.user_mentions.screen_name").alias("_names")
    mentions = msg.live(messages).select(pairs, names).select("topic", F.explode(F.array_distinct("_names")).alias("mention"))
    return {
        "topic_counts": tp.topic_counts(msg.topics(messages)),
        "user_topics": users.distinct(),
        "mention_topics": mentions.distinct(),
    }


#: How states of several batches become one.
MERGES = {
    "topic_counts": lambda df: df.groupBy("topic").agg(F.sum("num_tweets").alias("num_tweets")),
    "user_topics": lambda df: df.distinct(),
    "mention_topics": lambda df: df.distinct(),
}


def from_states(topic_counts: DataFrame, user_topics: DataFrame, mention_topics: DataFrame, n: int = 3) -> TopicReport:
    """The report from merged states: no message and no join on the message id.

    Equal to :func:`from_relations` as long as an id stands for one message.
    """
    top = tp.top_topics(topic_counts, n)
    return TopicReport(top, tp.names_of(user_topics, top, "user"), tp.names_of(mention_topics, top, "mention"))


# The report as SQL text over the relations {topics}, {users} and {mentions}.
_RANKED = """
    WITH counted AS (SELECT topic, count(*) AS num_tweets FROM {topics} GROUP BY topic),
    best AS (SELECT * FROM counted ORDER BY num_tweets DESC, topic LIMIT {n})
    SELECT topic, num_tweets, dense_rank() OVER (ORDER BY num_tweets DESC, topic) AS num_tweets_rnk FROM best
"""
_NAMES = """
    SELECT a.{who}, sort_array(collect_set(t.topic)) AS {result}
    FROM (SELECT DISTINCT id, {who} FROM {names}) a
    JOIN (SELECT DISTINCT id, topic FROM {topics} LEFT SEMI JOIN {top} USING (topic)) t USING (id)
    GROUP BY a.{who}
"""


def from_sql(topics: DataFrame, users: DataFrame, mentions: DataFrame, n: int = 3) -> TopicReport:
    """The report from SQL text, for users who adapt the statements."""
    spark = topics.sparkSession
    top = spark.sql(_RANKED, topics=topics, n=n)

    def names(frame: DataFrame, who: str) -> DataFrame:
        result = F.col(f"top_topics_of_{who}")
        return spark.sql(_NAMES, names=frame, topics=topics, top=top, who=F.col(who), result=result)

    return TopicReport(top, names(users, "user"), names(mentions, "mention"))

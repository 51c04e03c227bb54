"""Social topic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import messages as msg
from ..operators import topics as tp
from ..plans import topic_report
from ..session import scratch_path
from ..sources import files, testdata
from ..sources.store import TableStore
from . import query
from .fixtures import MESSAGES, RAW

TOP = 10


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.parse(testdata.message_lines(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages parsed once; the report passes over them several times."""
    return topic_report.prepare(_messages(spark, sf_dir))


def _flat(messages: DataFrame) -> DataFrame:
    return messages.select(
        "id",
        "created_at",
        "text",
        F.col("user.screen_name").alias("user"),
        F.array_join("entities.hashtags.text", ",").alias("topics"),
        F.array_join("entities.user_mentions.screen_name", ",").alias("mentions"),
        F.col("delete.status.id").alias("deleted_id"),
    )


_FLAT = f"""WITH {MESSAGES}
SELECT id, created_at, text, author AS "user", array_to_string(tags, ',') AS topics,
       array_to_string(named, ',') AS mentions, CAST(NULL AS BIGINT) AS deleted_id FROM msg
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, id FROM gone"""


@query(_FLAT)
def msg_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read from JSON-lines files."""
    path = scratch_path(spark, "messages")
    testdata.message_lines(spark, sf_dir).write.text(path)
    return _flat(files.read_messages(spark, path))


@query(_FLAT)
def msg_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages parsed from a string column."""
    return _flat(_messages(spark, sf_dir))


@query(f'WITH {MESSAGES} SELECT id, created_at, author AS "user" FROM msg')
def live_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.live(_messages(spark, sf_dir)).select("id", "created_at", F.col("user.screen_name").alias("user"))


@query(f'WITH {MESSAGES} SELECT id, "user" FROM users')
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.users(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT id, topic FROM topics")
def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.topics(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT id, mention FROM mentions")
def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.mentions(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT topic, num_tweets FROM counted")
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tp.topic_counts(topics(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT topic, count(DISTINCT id) AS num_tweets FROM topics GROUP BY topic")
def topic_message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct messages per topic."""
    return tp.topic_counts(topics(spark, sf_dir), distinct_messages=True)


@query(f"WITH {MESSAGES} SELECT topic, num_tweets FROM counted ORDER BY num_tweets DESC, topic")
def topic_counts_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tp.by_count(topic_counts(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT * FROM ranked WHERE num_tweets_rnk <= {TOP}")
def top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tp.top_topics(topic_counts(spark, sf_dir), TOP)


@query(f"""WITH {MESSAGES},
per_window AS (
  SELECT time_bucket(INTERVAL '2 hours', sent) AS window_start, unnest(tags) AS topic FROM msg WHERE sent IS NOT NULL),
sums AS (SELECT window_start, topic, count(*) AS num_tweets FROM per_window GROUP BY ALL),
placed AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY window_start ORDER BY num_tweets DESC, topic) AS INTEGER)
            AS num_tweets_rnk FROM sums)
SELECT * FROM placed WHERE num_tweets_rnk <= 3""")
def top_topics_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = tp.top_topics_per_window(_messages(spark, sf_dir), 3, "2 hours")
    return top.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH {MESSAGES}
SELECT u."user", t.topic, count(*) AS n FROM users u JOIN topics t ON t.id = u.id GROUP BY ALL""")
def topic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _stored(spark, sf_dir)
    return tp.topic_users(msg.users(messages), msg.topics(messages))


@query(f"""WITH {MESSAGES}
SELECT u."user", string_agg(DISTINCT t.topic, ',' ORDER BY t.topic) AS top_topics_of_user
FROM users u JOIN topics t ON t.id = u.id JOIN ranked r ON r.topic = t.topic
WHERE r.num_tweets_rnk <= {TOP} GROUP BY u."user\"""")
def top_topic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topic_report.from_messages(_stored(spark, sf_dir), TOP).users
    return found.select("user", F.array_join("top_topics_of_user", ",").alias("top_topics_of_user"))


@query(f"""WITH {MESSAGES}
SELECT m.mention, string_agg(DISTINCT t.topic, ',' ORDER BY t.topic) AS top_topics_of_mention
FROM mentions m JOIN topics t ON t.id = m.id JOIN ranked r ON r.topic = t.topic
WHERE r.num_tweets_rnk <= {TOP} GROUP BY m.mention""")
def top_topic_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topic_report.from_messages(_stored(spark, sf_dir), TOP).mentions
    return found.select("mention", F.array_join("top_topics_of_mention", ",").alias("top_topics_of_mention"))


_REPORT = f"""WITH {MESSAGES},
top AS (SELECT * FROM ranked WHERE num_tweets_rnk <= 3)
SELECT 'topic' AS part, topic AS name, num_tweets, num_tweets_rnk, CAST(NULL AS VARCHAR) AS topics FROM top
UNION ALL
SELECT 'user', u."user", NULL, NULL, string_agg(DISTINCT t.topic, ',' ORDER BY t.topic)
FROM users u JOIN topics t ON t.id = u.id JOIN top r ON r.topic = t.topic GROUP BY u."user"
UNION ALL
SELECT 'mention', m.mention, NULL, NULL, string_agg(DISTINCT t.topic, ',' ORDER BY t.topic)
FROM mentions m JOIN topics t ON t.id = m.id JOIN top r ON r.topic = t.topic GROUP BY m.mention"""


@query(_REPORT)
def interval_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-part report from messages at hand."""
    return topic_report.from_messages(_stored(spark, sf_dir), 3).as_rows()


@query(_REPORT)
def report_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-part report from SQL text over the three relations."""
    messages = _stored(spark, sf_dir)
    return topic_report.from_sql(msg.topics(messages), msg.users(messages), msg.mentions(messages), 3).as_rows()


@query(f"""WITH {MESSAGES} SELECT "user", count(*) AS num_tweets FROM (
  SELECT author AS "user" FROM msg UNION ALL SELECT '' FROM gone) GROUP BY "user\"""")
def user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.user_counts(_messages(spark, sf_dir))


@query(f"""WITH {MESSAGES} SELECT id, author AS "user" FROM msg UNION ALL SELECT NULL, 'unknown' FROM gone""")
def user_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.user_or_default(_messages(spark, sf_dir))


@query(f"""WITH {MESSAGES}
SELECT u.id, u."user", t.topic, m.mention FROM users u
LEFT JOIN topics t ON t.id = u.id LEFT JOIN mentions m ON m.id = u.id""")
def message_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.wide(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT id, array_to_string(list_concat([author], named), ',') AS people FROM msg")
def message_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.people(_messages(spark, sf_dir)).select("id", F.array_join("people", ",").alias("people"))


@query(f"""WITH {MESSAGES},
split AS (
  SELECT time_bucket(INTERVAL '2 hours', sent) AS window_start, author, string_split(text, ' ') AS ws FROM msg WHERE sent IS NOT NULL),
tagged AS (
  SELECT window_start, author, unnest(list_filter(ws, lambda w: starts_with(w, '#'))) AS topic,
         list_concat([author], list_filter(ws, lambda w: starts_with(w, '@'))) AS people FROM split),
sums AS (SELECT window_start, topic, count(*) AS num_tweets FROM tagged GROUP BY ALL),
top AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY num_tweets DESC, topic) AS place FROM sums),
pairs AS (SELECT DISTINCT window_start, topic, commentator
          FROM (SELECT window_start, topic, unnest(people) AS commentator FROM tagged)),
own AS (SELECT window_start, topic, author AS commentator, count(*) AS written FROM tagged GROUP BY ALL)
SELECT window_start, topic, commentator, num_tweets, coalesce(written, 0) AS written
FROM pairs JOIN top USING (window_start, topic) LEFT JOIN own USING (window_start, topic, commentator)
WHERE place <= 10""")
def topic_commentators(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tp.topic_commentators(_messages(spark, sf_dir), 10, "2 hours")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH {MESSAGES}
SELECT id, author AS "user", array_to_string(named, ',') AS mentions, array_to_string(tags, ',') AS topics,
       strftime(sent, '%Y-%m-%d %H:%M:%S') AS "timestamp", text FROM msg""")
def simple_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened record, stamped with the message's own time to be repeatable."""
    timed = msg.with_time(_messages(spark, sf_dir))
    simple = msg.simple(timed, clock=F.col("ts"))
    return simple.withColumns({c: F.array_join(c, ",") for c in ("mentions", "topics")})


@query(f"WITH {MESSAGES} SELECT id, created_at FROM msg")
def msg_id_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.id_and_time(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT count(*) AS messages, count(*) FILTER (sent IS NULL) AS unreadable FROM msg")
def unreadable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose time can't be read: counted, as no window holds them."""
    return msg.unreadable_times(_messages(spark, sf_dir))


@query(f"WITH {MESSAGES} SELECT id FROM msg UNION ALL SELECT NULL FROM gone")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.json_id(testdata.message_lines(spark, sf_dir))


def _stored_topics(spark: SparkSession, sf_dir: str) -> TableStore:
    store = TableStore(spark, scratch_path(spark, "store"), {"topics": schemas.TOPICS})
    store.write_batch(topics(spark, sf_dir), "topics", "load", 0)
    return store


@query(f"WITH {MESSAGES} SELECT id, topic FROM topics")
def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation appended to the table store and read back."""
    return _stored_topics(spark, sf_dir).read("topics")


@query(f"WITH {MESSAGES} SELECT id, topic FROM topics ORDER BY id, topic LIMIT 3")
def history_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three rows of a stored relation."""
    return _stored_topics(spark, sf_dir).read("topics").orderBy("id", "topic").limit(3)


_BATCHES = 12


def _history(spark: SparkSession, sf_dir: str) -> TableStore:
    """Topics of twelve mini-batches, the closed ones merged into one run, and a replay of a merged batch."""
    store = TableStore(spark, scratch_path(spark, "store"), {"topics": schemas.TOPICS})
    found = topics(spark, sf_dir)
    batch = F.pmod("id", F.lit(_BATCHES))
    store.load(found, "topics", "load", batch)
    store.compact("topics")
    store.write_batch(found.where(batch == 3), "topics", "load", 3)
    return store


@query(f"WITH {MESSAGES} SELECT id, topic, id % {_BATCHES} AS batch FROM topics")
def history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of several mini-batches after compaction."""
    read = _history(spark, sf_dir).read("topics", with_batch=True)
    # A replayed batch is in the run once.
    return read.select("id", "topic", F.col("batch_id").alias("batch"))


@query(f"""WITH {MESSAGES}, bounds AS (SELECT max(event_id) // 3 AS low, max(event_id) // 3 + 500 AS high FROM events)
SELECT id, topic FROM topics, bounds WHERE id BETWEEN low AND high""")
def history_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of ids out of a compacted history, from the files that may hold it."""
    low = testdata.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 3
    return _history(spark, sf_dir).lookup("topics", low, low + 500)


@query(f"""WITH {RAW}, said AS (
  SELECT event_id AS id, event_type AS topic FROM raw UNION ALL SELECT event_id, 'k' || kk FROM raw)
SELECT id, topic FROM said WHERE id % 7 <> 0""")
def deletes_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history without the messages that were deleted, by notices before, with and after them.

    Every event says its type and its number. A notice for each seventh comes in a
    batch of its own choice; half of the batches are compacted with the notices known by then.
    """
    events = testdata.table(spark, sf_dir, "events")
    words = F.array("event_type", F.concat(F.lit("k"), F.get_json_object("props", "$.k")))
    said = events.select(F.col("event_id").alias("id"), F.explode(words).alias("topic"))
    gone = events.where("event_id % 7 = 0").select(F.col("event_id").alias("id"))
    tables = {"topics": schemas.TOPICS, "deleted": schemas.DELETED}
    store = TableStore(spark, scratch_path(spark, "store"), tables, tombstones="deleted")
    batch, notice = F.pmod("id", F.lit(_BATCHES)), F.pmod(F.floor(F.col("id") / 7), F.lit(_BATCHES))
    for first in (0, _BATCHES // 2):
        half = (F.lit(first), F.lit(first + _BATCHES // 2 - 1))
        store.load(gone.where(notice.between(*half)), "deleted", "load", notice)
        store.load(said.where(batch.between(*half)), "topics", "load", batch)
        store.compact("deleted")
        store.compact("topics")
    return store.read("topics", live=True)


@query(f"""WITH {MESSAGES} SELECT id, author AS "user" FROM msg
WHERE CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 0""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable one-in-ten sample of the messages."""
    return msg.sample(_messages(spark, sf_dir), 10).select("id", F.col("user.screen_name").alias("user"))


@query(f"""WITH {MESSAGES} SELECT t.id, t.topic FROM topics t""")
def deletes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of all events, deleted ones included, after the deletes took effect."""
    events = testdata.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    # Unpacked topics outgrow the planner's estimate by far: no broadcast.
    everything = events.join(topics(spark, sf_dir).hint("merge"), "id", "left")
    return msg.apply_deletes(everything, _messages(spark, sf_dir))

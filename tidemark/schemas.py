"""Explicit schemas of every record kind; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# One social message; a tombstone fills only `delete` and leaves `id` NULL.
MESSAGE = _struct(
    id=_LONG,
    created_at=_STRING,
    text=_STRING,
    user=_struct(screen_name=_STRING),
    entities=_struct(
        hashtags=T.ArrayType(_struct(text=_STRING)),
        user_mentions=T.ArrayType(_struct(screen_name=_STRING)),
    ),
    delete=_struct(status=_struct(id=_LONG, id_str=_STRING)),
)

TOPICS = _struct(id=_LONG, topic=_STRING)
USERS = _struct(id=_LONG, user=_STRING)
MENTIONS = _struct(id=_LONG, mention=_STRING)
DELETED = _struct(id=_LONG)
SLIM = _struct(id=_LONG, author=_STRING, tweet=_STRING)

# What the report over all history needs of each mini-batch.
TOPIC_COUNTS = _struct(topic=_STRING, num_tweets=_LONG)
USER_TOPICS = _struct(topic=_STRING, user=_STRING)
MENTION_TOPICS = _struct(topic=_STRING, mention=_STRING)

# One telemetry event: raw body plus its property map.
ENVELOPE = _struct(body=T.BinaryType(), properties=T.MapType(_STRING, _STRING))
METRIC = _struct(g=_STRING, k=_STRING, v=_STRING, t=_LONG)
METRIC_BATCH = _struct(Data=T.ArrayType(METRIC))
METRIC_CSV = _struct(g=_STRING, k=_STRING, t=_LONG, v=_STRING)

NGRAM = _struct(
    bi_gram=_STRING, year=_INT, match_count=_LONG, page_count=_LONG, volume_count=_LONG
)
BIGRAM_COUNT = _struct(gram0=_STRING, gram1=_STRING, matchcount=_LONG)

SATELLITE = _struct(
    t=_LONG,
    d=T.ArrayType(_struct(PRN=_INT, el=_INT, az=_INT, ss=_INT, used=T.BooleanType())),
)
AVERAGES = _struct(
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
    k=_STRING,
    average_value=T.DoubleType(),
    n=_LONG,
    rejects=_LONG,
)
TAG_COUNTS = _struct(tag=_STRING, count=_LONG)
WORD_COUNTS = _struct(word=_STRING, total=_LONG)
WINDOW_TOPICS = _struct(window_start=T.TimestampType(), topic=_STRING, num_tweets=_LONG)
WINDOW_TAGS = _struct(window_start=T.TimestampType(), tag=_STRING, count=_LONG)
# A tag's newest total; NULL once the tag has been idle for too long.
TAG_TOTALS = _struct(tag=_STRING, count=_LONG, batch=_LONG)
# What a mini-batch held: messages, delete notices, texts that are neither, messages without a readable time.
INTAKE = _struct(lines=_LONG, messages=_LONG, notices=_LONG, unreadable=_LONG, untimed=_LONG)
BROKER = _struct(topic=_STRING, value=_STRING)

SENSOR_COLUMNS = ("product_id", "qc_lot", "time", "w_x", "w_y", "w_z")

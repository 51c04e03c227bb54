from __future__ import annotations

import json

from conftest import lines
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import messages as msg
from tidemark.operators import topics as tp
from tidemark.plans import topic_report


def message(id, user="u1", tags=(), named=(), text="", created="2024-01-01 00:00:00"):
    return json.dumps(
        {
            "id": id,
            "created_at": created,
            "text": text,
            "user": {"screen_name": user},
            "entities": {
                "hashtags": [{"text": t} for t in tags],
                "user_mentions": [{"screen_name": m} for m in named],
            },
        },
        ensure_ascii=False,
    )


TOMBSTONE = '{"delete":{"status":{"id":9,"id_str":"9"}}}'


def parsed(spark, *texts):
    return msg.parse(lines(spark, texts))


def test_relations_of_one_message(spark, rows):
    m = parsed(spark, message(1, "u1", ["a", "b"], ["u2"]))
    assert rows(msg.topics(m)) == [(1, "a"), (1, "b")]
    assert rows(msg.users(m)) == [(1, "u1")]
    assert rows(msg.mentions(m)) == [(1, "u2")]


def test_repeated_tag_counts_twice_unless_distinct(spark, rows):
    t = msg.topics(parsed(spark, message(1, tags=["a", "a"])))
    assert rows(tp.topic_counts(t)) == [("a", 2)]
    assert rows(tp.topic_counts(t, distinct_messages=True)) == [("a", 1)]


def test_empty_lists_keep_the_user(spark, rows):
    m = parsed(spark, message(1))
    assert rows(msg.topics(m)) == []
    assert rows(msg.users(m)) == [(1, "u1")]
    assert rows(msg.wide(m)) == [(1, "u1", None, None)]


def test_tombstones_and_broken_lines_give_empty_relations(spark, rows):
    m = parsed(spark, TOMBSTONE, "not json", "{}")
    for relation in (msg.topics(m), msg.users(m), msg.mentions(m), msg.live(m)):
        assert relation.count() == 0
    report = topic_report.from_messages(m, 3)
    assert [frame.count() for frame in report] == [0, 0, 0]
    assert rows(msg.deleted_ids(m)) == [(9,)]


def test_missing_entities_are_no_error(spark, rows):
    m = parsed(spark, '{"id": 5, "user": {"screen_name": "u"}}', '{"id": 6}')
    assert rows(msg.topics(m)) == []
    assert rows(msg.users(m)) == [(5, "u"), (6, None)]
    assert rows(msg.simple(m, F.lit("2024-01-01 00:00:00").cast("timestamp")), "id", "mentions", "topics") == [
        (5, [], []),
        (6, [], []),
    ]
    assert rows(msg.people(m)) == [(5, ["u"]), (6, [None])]


def test_ties_rank_apart_and_in_binary_order(spark):
    t = msg.topics(parsed(spark, message(1, tags=["บ", "한", "b", "a", "Z"])))
    top = tp.top_topics(tp.topic_counts(t), 4).orderBy("num_tweets_rnk").collect()
    assert [(r.topic, r.num_tweets_rnk) for r in top] == [("Z", 1), ("a", 2), ("b", 3), ("บ", 4)]


def test_user_counts_put_missing_authors_under_empty(spark, rows):
    m = parsed(spark, message(1, "x"), message(2, "x"), TOMBSTONE)
    assert rows(msg.user_counts(m)) == [("", 1), ("x", 2)]
    assert rows(msg.user_or_default(m), "user") == [("unknown",), ("x",), ("x",)]


def test_deletes_leave_the_history_only_on_request(spark, rows):
    m = parsed(spark, message(9, tags=["a"]), message(10, tags=["b"]), TOMBSTONE)
    assert rows(msg.topics(m)) == [(9, "a"), (10, "b")] or rows(msg.topics(m)) == [(10, "b"), (9, "a")]
    assert rows(msg.apply_deletes(msg.topics(m), m)) == [(10, "b")]


def test_report_forms_agree_also_with_copies(spark, rows):
    texts = [message(i, f"u{i % 7}", [f"t{i % 5}", f"t{i % 3}"], [f"u{i % 4}"]) for i in range(60)]
    m = parsed(spark, *texts, *texts[:20], TOMBSTONE)
    relations = (msg.topics(m), msg.users(m), msg.mentions(m))
    one = topic_report.from_messages(m, 3).as_rows()
    two = topic_report.from_relations(*relations, 3).as_rows()
    three = topic_report.from_sql(*relations, 3).as_rows()
    assert rows(one) == rows(two) == rows(three)
    assert rows(topic_report.from_messages(topic_report.prepare(m), 3).as_rows()) == rows(one)


def test_topic_users_equals_the_plain_join(spark, rows):
    texts = [message(i % 10, f"u{i % 3}", [f"t{i % 4}", "x"]) for i in range(40)]
    m = parsed(spark, *texts)
    joined = msg.users(m).join(msg.topics(m), "id").groupBy("user", "topic").agg(F.count("*").alias("n"))
    assert rows(tp.topic_users(msg.users(m), msg.topics(m))) == rows(joined)


def test_commentators_per_topic(spark, rows):
    m = parsed(
        spark,
        message(1, "ann", text="#x hello @bob"),
        message(2, "bob", text="#x #y @ann @ann"),
        message(3, "cat", text="no topic"),
    )
    found = tp.topic_commentators(m, n=1).select("topic", "num_tweets", "commentator", "written")
    assert rows(found) == [
        ("#x", 2, "@ann", 0),
        ("#x", 2, "@bob", 0),
        ("#x", 2, "ann", 1),
        ("#x", 2, "bob", 1),
    ]


def test_top_per_window(spark, rows):
    m = parsed(
        spark,
        message(1, tags=["a", "a", "b"]),
        message(2, tags=["c"], created="2024-01-01 05:00:00"),
    )
    found = tp.top_topics_per_window(m, 1, "1 hour").select("topic", "num_tweets", "num_tweets_rnk")
    assert rows(found) == [("a", 2, 1), ("c", 1, 1)]


def test_sample_is_repeatable_and_about_right(spark):
    m = spark.range(10_000).select(F.col("id"))
    first = {r.id for r in msg.sample(m, 10).collect()}
    assert first == {r.id for r in msg.sample(m.repartition(7), 10).collect()}
    assert 800 < len(first) < 1200


def test_message_schema_reads_files(spark, rows, tmp_path):
    from tidemark.sources import files

    path = tmp_path / "m.json"
    path.write_text(message(1, tags=["a"]) + "\n" + TOMBSTONE + "\nnot json\n")
    m = files.read_messages(spark, str(path))
    assert m.schema.fieldNames() == schemas.MESSAGE.fieldNames()
    assert rows(msg.topics(m)) == [(1, "a")]

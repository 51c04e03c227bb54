"""Many broker filters and many keywords at once."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from tidemark.functions import text as tx
from tidemark.operators import broker, keywords


def frame(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string").repartition(3)


def accepted(topic, topic_filter):
    try:
        pattern = tx.topic_pattern(topic_filter)
    except ValueError:
        return False
    return re.search(pattern.replace("\\z", "\\Z"), topic, re.DOTALL) is not None


def test_trie_equals_one_pattern_a_filter(spark, rows):
    draw = random.Random(4)
    words = ["a", "b", "", "+", "#", "a.c", "x*"]
    topics = ["", "/", "a", "a/", "/a", "a/b", "a//b", "a/b/c", "+", "a/+", "#", "a.c/x*"]
    topics += ["/".join(draw.choice(words[:5]) for _ in range(draw.randint(1, 5))) for _ in range(150)]
    filters = ["", "#", "/#", "a/#", "+", "+/+", "a/+/#", "a/b", "a//b", "/+", "+/", "a/b/c/d/e/f", "a/#/b", "#/a"]
    filters += ["/".join(draw.choice(words) for _ in range(draw.randint(1, 5))) for _ in range(300)]
    got = broker.matching_filters(frame(spark, "topic", [*topics, None, "a"]), frame(spark, "filter", [*filters, None, "#"]))
    want = {(t, f) for t in topics for f in filters if accepted(t, f)}
    assert rows(got) == sorted(want, key=repr)
    assert broker.matching_filters(frame(spark, "topic", topics), frame(spark, "filter", [None])).isEmpty()
    assert broker.matching_filters(frame(spark, "topic", [None]), frame(spark, "filter", filters)).isEmpty()


def test_ten_thousand_filters_are_joined_by_equality(spark, rows):
    filters = spark.range(10_000).select(
        F.concat(F.lit("dev/"), F.col("id") % 500, F.when(F.col("id") % 3 == 0, "/+/t").otherwise("/x/"), F.col("id")).alias("filter")
    )
    topics = spark.range(2_000).select(F.concat(F.lit("dev/"), F.col("id") % 500, F.lit("/x/"), F.col("id")).alias("topic"))
    messages = topics.withColumn("value", F.lit(1))
    routed = broker.route(messages, filters)
    text = plan(routed)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert routed.count() == sum(i % 3 != 0 for i in range(2_000))
    assert routed.columns == ["topic", "value", "filter"]


@pytest.mark.parametrize("size", [1, 2, 3, 8])
def test_keywords_equal_a_search_for_each(spark, rows, size):
    draw = random.Random(size)
    texts = ["".join(draw.choice("abAé \n\U0001f600") for _ in range(draw.randint(0, 60))) for _ in range(80)]
    asked = ["".join(draw.choice("abé\U0001f600") for _ in range(draw.randint(1, size))) for _ in range(60)]
    asked += ["", "never there", texts[0].upper()[:20], texts[1]]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate([*texts, None])], "id int, text string, part string, size int")
    got = keywords.track_many(df, frame(spark, "keyword", [*asked, None]))
    assert got.columns == ["id", "text", "part", "size", "keyword"]
    want = {(i, k.lower()) for i, t in enumerate(texts) for k in asked if k and k.lower() in t.lower()}
    assert rows(got, "id", "keyword") == sorted(want, key=repr)


def test_keywords_of_nothing(spark):
    df = frame(spark, "text", ["some text"])
    assert keywords.track_many(df, frame(spark, "keyword", ["", None])).isEmpty()
    assert keywords.track_many(df.limit(0), frame(spark, "keyword", ["a"])).isEmpty()


def test_long_texts_are_cut_in_one_pass(spark, rows):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("ab cd "), 50_000), F.lit("end")).alias("text"))
    got = keywords.track_many(df, frame(spark, "keyword", ["d end", "d  end", "cd"]))
    assert rows(got, "keyword") == [("cd",), ("d end",)]
    text = plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_only_what_a_text_holds_is_joined(spark, rows):
    # All of a text's parts are common, and few of the keywords that have them are in it.
    texts = spark.range(300).select(F.concat(F.lit("the abcabc "), F.col("id")).alias("text"))
    asked = spark.range(2_000).select(F.concat(F.lit("abc "), F.col("id")).alias("keyword"))
    got = keywords.track_many(texts, asked)
    assert got.count() == sum(len(str(i)) for i in range(300))
    assert len(re.findall(r"Join \[", plan(got))) == 1


def test_windows_across_the_pieces_of_a_text_are_found(spark, rows):
    piece = keywords._PIECE
    asked = ["needle", "the whole Needle in the hay", "é\U0001f600é", "zz", "needl\0"]
    texts = ["x" * (piece - n) + "the whole needle in the hay" + "é\U0001f600é" * n for n in range(0, 40, 13)]
    texts += ["y" * 3 * piece, "the whole needle in the\thay", "n", "", None, "é\U0001f600"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    got = keywords.track_many(df, frame(spark, "keyword", asked))
    want = {(i, k.lower()) for i, t in enumerate(texts) if t for k in asked if k.lower() in t}
    assert rows(got, "id", "keyword") == sorted(want, key=repr) and len(want) == 12


def test_what_many_texts_hold_is_not_moved(spark, rows):
    # Keywords over 16 bytes took the text of each find along.
    texts = spark.range(200).select(F.concat(F.repeat(F.lit("a common passage of them all "), 20), F.col("id")).alias("text"))
    asked = spark.range(500).select(F.concat(F.lit("passage of them all "), F.col("id")).alias("keyword"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = keywords.track_many(texts, asked.unionByName(frame(spark, "keyword", ["a", "common", "a common passage "])))
        counts = got.groupBy("keyword").agg(F.count("*").alias("n"))
        assert "SortMergeJoin" not in plan(counts) and "ShuffledHashJoin" not in plan(counts)
        found = dict(rows(counts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [found.pop(k) for k in ("a", "common", "a common passage ")] == [200, 200, 200]
    want = {f"passage of them all {n}": sum(str(i).startswith(str(n)) for i in range(200)) for n in range(200)}
    assert found == want


@pytest.mark.parametrize(("held", "joins"), [(0, 1), (30, 2), (100, 1)])
def test_keywords_that_tasks_do_not_hold_are_joined(spark, rows, monkeypatch, held, joins):
    monkeypatch.setattr(keywords, "_HELD", held)
    draw = random.Random(held)
    passage = "".join(draw.choice("abcdé ") for _ in range(150))
    texts = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(0, 40))) for _ in range(30)]
    texts += [passage[n : n + draw.randint(1, 150)] for n in range(0, 150, 5)]
    texts += ["x" * (keywords._PIECE - n) + passage for n in (1, 40)]
    asked = [passage[n : n + draw.randint(1, 75)] for n in range(80)] + ["ab"] * 3 + ["é", "d a"]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "id int, text string").repartition(2)
    got = keywords.track_many(df, frame(spark, "keyword", asked))
    want = {(i, k) for i, t in enumerate(texts) for k in asked if k in t}
    assert rows(got, "id", "keyword") == sorted(want, key=repr)
    assert rows(got, "id", "text") == sorted(((i, texts[i]) for i, _ in want), key=repr)
    # No text moves with a find, unless it is the head of a longer keyword.
    short = keywords.track_many(df, frame(spark, "keyword", [k for k in asked if len(k.encode()) <= keywords._HEAD]))
    text = plan(short.groupBy("keyword").count())
    assert len(re.findall(r"Join \[", text)) == joins
    assert all("_lower" not in line and "text" not in line for line in text.splitlines() if "Generate " in line)


def test_no_keyword_runs_from_one_text_to_the_next(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["abab", "abab", "aab", "b", "", "abab"])], "id int, text string").coalesce(1)
    got = keywords.track_many(df, frame(spark, "keyword", ["ab", "ba", "bb", "abababab", "aabb", "aa"]))
    assert rows(got, "id", "keyword") == [(0, "ab"), (0, "ba"), (1, "ab"), (1, "ba"), (2, "aa"), (2, "ab"), (5, "ab"), (5, "ba")]

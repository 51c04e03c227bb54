"""The physical plans hold what they should, and nothing that does not scale."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tidemark import catalog, schemas
from tidemark.operators import bigrams, scan, transitions, walks, words
from tidemark.operators import messages as msg
from tidemark.operators import topics as tp
from tidemark.session import bucketed, scratch_path
from tidemark.sources import files, testdata
from tidemark.sources.store import TableStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_top_topics_use_a_distributed_top_k(spark):
    messages = msg.parse(testdata.message_lines(spark, SMALL))
    text = plan(tp.top_topics(tp.topic_counts(msg.topics(messages))))
    assert "TakeOrderedAndProject" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_ranking_per_window_drops_rows_before_the_shuffle(spark):
    messages = msg.parse(testdata.message_lines(spark, SMALL))
    assert "WindowGroupLimit" in plan(tp.top_topics_per_window(messages))


def test_text_of_a_message_is_parsed_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    assert plan(msg.users(msg.parse(lines))).count("from_json(") == 1


def test_projections_do_not_shuffle(spark):
    messages = msg.parse(spark.createDataFrame([("{}",)], "value string"))
    for df in (msg.wide(messages), msg.people(messages), msg.simple(messages), msg.slim(messages)):
        assert "Exchange" not in plan(df)
    ngrams = spark.createDataFrame([("a b", 1)], "bi_gram string, match_count bigint")
    assert "Exchange" not in plan(bigrams.clean(ngrams))


def _shape(df):
    """A plan without the numbers, names of files and sizes in it."""
    return re.sub(r"#\d+L?|id=#?\d+|\[file:[^\]]*\]|numbers? \d+", "", plan(df))


@pytest.mark.parametrize("name", ["running_mean", "series_ordinals", "transition_probs", "next_words", "topic_counts"])
def test_one_plan_serves_small_and_large_tables(spark, name):
    query = entry_points.queries()[name]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = (_shape(query(spark, SMALL.replace("0.001", sf))) for sf in ("0.001", "0.1"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == large


def test_input_is_not_dealt_out(spark):
    assert "Exchange" not in plan(testdata.ngrams(spark, SMALL))
    assert "Exchange" not in plan(testdata.message_lines(spark, SMALL))


def test_counts_shuffle_once_after_a_partial_count(spark):
    for df in (
        words.word_count(testdata.table(spark, SMALL, "documents"), "text"),
        bigrams.counts(bigrams.clean(testdata.ngrams(spark, SMALL))),
    ):
        assert plan(df).count("Exchange hashpartitioning") == 1
        assert plan(df).count("HashAggregate") == 2


def test_scan_reads_only_the_text(spark):
    text = plan(words.word_count(testdata.table(spark, SMALL, "documents"), "text"))
    assert "ReadSchema: struct<text:string>" in text


def test_literal_word_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "counts")
    spark.createDataFrame([("a", "b", 1)], schemas.BIGRAM_COUNT).write.parquet(path)
    text = plan(transitions.successors(spark.read.parquet(path), "a"))
    assert "EqualTo(gram0,a)" in text


def test_file_slice_prunes_folders(spark):
    path = scratch_path(spark, "corpus")
    lines = testdata.ngrams(spark, SMALL).drop("doc_id", "pos")
    files.write_tsv(lines, path, partition_by=["file_no"])
    read = files.read_ngrams(spark, path, entry_points.catalog.corpus._FILE_NO)
    text = plan(bigrams.file_slice(read, 0, 9))
    assert "PartitionFilters: [isnotnull(file_no" in text


def test_one_batch_of_the_store_prunes_folders(spark):
    store = TableStore(spark, scratch_path(spark, "store"), {"topics": schemas.TOPICS})
    store.write_batch(spark.createDataFrame([(1, "a")], schemas.TOPICS), "topics", "q", 3)
    text = plan(store.read("topics", with_batch=True).where("batch_id = 3"))
    assert "PartitionFilters: [isnotnull(batch_id" in text


def test_runs_are_stored_once_and_only_edges_move(spark):
    lines = testdata.ngrams(spark, SMALL)
    text = plan(bigrams.run_totals(lines, ["doc_id", "pos"], F.floor(F.col("doc_id") / 10)))
    # The runs are read from their table; one shuffle puts the edge rows together.
    assert text.count("Exchange hashpartitioning") == 1


def test_a_step_moves_only_the_walkers(spark):
    totals = spark.createDataFrame([(f"w{i % 50}", f"w{i % 49}", i) for i in range(1, 400)], "gram0 string, gram1 string, n bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = totals.agg(F.sum("n")).first()[0]
        ranges = walks.word_ranges(totals, whole)
        index = bucketed(walks.walk_index(totals, ranges, whole), ["gram0", "slot"], "index")
        start = spark.range(100).select(F.col("id").alias("walk_id"), F.expr("concat('w', id % 50)").alias("gram0"))
        walkers = start.selectExpr("walk_id", "1 as words", "gram0 as phrase", "gram0", "walk_id % 7 as place", "walk_id % 3 as slot")
        text = plan(walks._step(walkers, index, 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 1


def test_totals_sort_rows_once(spark):
    points = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(scan.prefix_totals(points, ["k"], ["id"], {"n": F.lit(1)}))
    # Rows are dealt by their part of a key; sums of the parts by part and by key.
    assert text.count("Exchange hashpartitioning") <= 3 and "Broadcast" not in text


def test_deletes_are_dealt_out_and_not_broadcast(spark):
    # Unpacked rows outgrow the estimate that the planner has of them from the size of the file.
    text = plan(entry_points.queries()["deletes_applied"](spark, SMALL))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 2


def test_corpus_files_move_texts_and_not_lines(spark, rows, monkeypatch):
    written = []
    monkeypatch.setattr(files, "write_tsv", lambda df, path, **_: (written.append(df), df.write.csv(path)))
    for query in ("ngram_scan", "ngram_scan_gzip", "corpus_slice"):
        entry_points.queries()[query](spark, SMALL)
    for df in written:
        text = plan(df)
        assert text.index("Generate") < text.index("Exchange") and text.count("Exchange") == 1
    lines = testdata.ngrams(spark, SMALL)
    assert rows(testdata.ngrams(spark, SMALL, by_file=True)) == rows(lines)


def test_a_step_sorts_nothing_and_its_index_names_no_next_range(spark):
    totals = spark.createDataFrame([(f"w{i % 50}", f"w{i % 49}", i) for i in range(1, 400)], "gram0 string, gram1 string, n bigint")
    whole = totals.agg(F.sum("n")).first()[0]
    index = bucketed(walks.walk_index(totals, walks.word_ranges(totals, whole), whole), ["gram0", "slot"], "index")
    assert index.columns == ["gram0", "gram1", "cum_lo", "cum_hi", "slot"]
    word = "concat('w', id % 50)"
    walkers = spark.range(100).selectExpr("id as walk_id", "1 as words", f"{word} as phrase", f"{word} as gram0", "id % 7 as place", "id % 3 as slot")
    text = plan(walks._step(walkers, index, 1))
    assert "ShuffledHashJoin" in text and "Sort " not in text and text.count("Exchange") == 1

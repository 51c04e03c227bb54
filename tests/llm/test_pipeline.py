from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing

from .conftest import SMALL, prose
from .test_decontaminate import words
from .test_near_dup import brute


def test_every_stage_against_a_plain_version(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        path = corpus_pipeline.store(docs, "stage")
        seen.append(path.collect())
        docs = path
        if stage is not corpus_pipeline.shards:
            assert docs.columns == columns
    clean, single, free, mixed, placed = seen

    toxic = {"idiot", "moron", "loser", "scum", "clown", "stupid", "disgusting", "worthless", "pathetic", "trash"}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    bad = {i for i, t in texts.items() if len(toxic & set(words(t).split())) >= 2}
    good = {i for i, t in texts.items() if not toxic & set(words(t).split())}
    kept = {r.doc_id for r in clean}
    assert len(bad & kept) <= 0.1 * len(bad) and len(good - kept) <= 0.02 * len(good)

    pairs = [(r.doc_id, r.text) for r in clean]
    assert {r.doc_id for r in single} == {i for (i, _), (_, c) in zip(pairs, brute(pairs), strict=True) if i == c}
    items = [words(t) for (t,) in duckdb.sql(f"SELECT text FROM '{sf}/benchmark.parquet'").fetchall()]
    leaks = {r.doc_id for r in single if any(x in words(r.text) for x in items)}
    assert leaks and not leaks & {r.doc_id for r in free}
    assert len(single) - len(free) <= len(leaks) + 5

    count = Counter(r.doc_id for r in mixed)
    assert set(count) == {r.doc_id for r in free} and max(count.values()) <= 5
    tokens = Counter()
    for r in mixed:
        tokens[r.source] += len(r.text.split())
    source = Counter()
    for r in free:
        source[r.source] += len(r.text.split())
    assert max(tokens.values()) / sum(tokens.values()) <= max(source.values()) / sum(source.values()) + 0.01
    assert mixing.exponent(list(source.values()), 0.95, 4.0) <= 1

    assert Counter(r.doc_id for r in placed) == count
    per_shard = Counter(r.shard for r in placed)
    assert sorted((r.shard, r.slot) for r in placed) == sorted((s, i) for s, n in per_shard.items() for i in range(n))
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 for r in placed)


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 100 and {"doc_id", "shard", "slot"} <= set(rows.columns)


def test_empty_documents_pass_all_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_names_that_operators_use_survive_every_stage(spark):
    extra = ["toxicity", "matches", "short_items", "turn", "passes", "last", "copies", "n", "d"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in extra})
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SMALL), "stage")
        assert docs.columns == columns
        assert docs.count() and docs.where(" OR ".join(f"{c} != concat('{c}', doc_id)" for c in extra)).isEmpty()


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    pairs = [(7, b), (8, b), (7, a), (5, a), (None, c), (None, c), (9, c), (None, prose(4, 80)), (6, ""), (6, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "s", k) for k, (i, t) in enumerate(pairs)], "doc_id long, text string, source string, _n int")
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SMALL)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert rows == sorted([(7, b), (5, a), (None, c), (None, prose(4, 80)), (6, ""), (6, ""), (None, None)], key=repr)

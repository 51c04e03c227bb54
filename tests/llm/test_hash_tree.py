from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm.hash_tree import assign, grown, op8_hash_tree, place, sharded, tree

from .conftest import SMALL


def test_query(spark):
    sf = SMALL.replace("0.001", "0.1")
    rows = op8_hash_tree(spark, sf).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    assert len(rows) == len(texts) and {r.doc_id for r in rows} == set(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
    count = Counter(r.shard for r in rows)
    assert set(count) == set(range(8)) and max(count.values()) < 1.2 * min(count.values())
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(8) for i in range(count[s])]
    moved = sum(r.grown_shard == 8 for r in rows)
    assert 0.9 < moved * 9 / len(rows) < 1.1


@pytest.mark.parametrize("n", [1, 3, 8, 9, 17])
def test_growth_moves_rows_only_into_the_new_shard(spark, n):
    old = tree(n)
    ids = spark.range(20_000).select(place(F.col("id"), old).alias("a"), place(F.col("id"), grown(old)).alias("b"))
    pairs = ids.groupBy("a", "b").count().collect()
    assert {r.a for r in pairs} == set(range(n))
    assert all(r.b in (r.a, n) for r in pairs)
    assert 0.85 < sum(r["count"] for r in pairs if r.b == n) * (n + 1) / 20_000 < 1.15


def test_a_weight_moves_rows_only_into_its_subtrees(spark):
    old = [[{0: 1.0, 1: 1.0}, {2: 1.0}], [{3: 2.0}, {4: 0.0, 5: 3.0}]]
    new = [[{0: 1.0, 1: 1.0}, {2: 1.0}], [{3: 2.0}, {4: 0.0, 5: 6.0}]]
    ids = spark.range(30_000).select(place(F.col("id"), old).alias("a"), place(F.col("id"), new).alias("b"))
    pairs = {(r.a, r.b): r["count"] for r in ids.groupBy("a", "b").count().collect()}
    assert not any(4 in p for p in pairs)
    region = {0: 0, 1: 0, 2: 0, 3: 1, 5: 1}
    assert all(a == b or region[b] == 1 for a, b in pairs) and (5, 3) not in pairs
    share = {s: sum(n for (a, _), n in pairs.items() if a == s) / 30_000 for s in region}
    assert all(abs(share[s] - w / 8) < 0.015 for s, w in [(0, 1), (1, 1), (2, 1), (3, 2), (5, 3)])


def test_cases(spark, documents):
    pairs = [(None, "a"), (None, None), (1, ""), (1, ""), (1, "é" * 40_000), (2, None)]
    rows = sharded(documents(pairs), tree(8)).collect()
    assert sorted(r["size"] for r in rows) == [1, 1, 1, 1, 2, 80_001]
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(s) == 1 for s in by_id.values())
    assert sorted((r.shard, r.slot) for r in rows) == sorted(
        (s, i) for s, n in Counter(r.shard for r in rows).items() for i in range(n)
    )
    assert sharded(documents([]), tree(8)).count() == 0
    assert assign(documents(pairs), tree(3)).columns[-1] == "shard"
    with pytest.raises(ValueError):
        place(F.col("id"), [[{0: 0.0}]])

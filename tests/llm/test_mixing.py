from __future__ import annotations

import math
from collections import Counter, defaultdict

import duckdb
import pytest

from tidemark.llm.mixing import copies, exponent, mixed, op4_temperature_mixing, plan

from .conftest import SMALL, prose


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


def test_exponent():
    tokens = [1000, 200, 100, 50]
    a = exponent(tokens, 0.95, 1e9)
    parts = [t**a for t in tokens]
    assert entropy(p / sum(parts) for p in parts) == pytest.approx(0.95 * math.log(4), abs=1e-9)
    a = exponent(tokens, 1.0, 4.0)
    assert (1000 / 50) ** (1 - a) == pytest.approx(4.0)
    assert exponent([5, 5, 5], 0.9, 4) == 1.0 and exponent([7], 0.9, 4) == 1.0


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, tokens string, copies int"
    ).repartition(3)


def test_copies_keep_to_the_quotas(spark):
    rows = [(i, prose(i, 1 + i % 30), "big") for i in range(900)] + [(2000 + i, prose(i, 20), "mid") for i in range(80)]
    rows += [(3000 + i, prose(i, 10), None) for i in range(30)] + [(4000, "", "none"), (4001, None, "none")]
    docs = frame(spark, rows)
    for budget in (None, 9_000, 40_000):
        plans = plan(docs, repeats=1e9, budget=budget, blocks=16)
        by_source = {r.source: r for r in plans.collect()}
        got = copies(docs, plans, blocks=16).collect()
        assert len(got) == len(rows) and got[0].__fields__ == [*docs.columns[:-1], "copies"]
        used, sizes = Counter(), defaultdict(list)
        for r in got:
            n = len((r.text or "").split())
            used[r.source] += n * r.copies
            sizes[r.source].append(r.copies)
        for source, p in by_source.items():
            assert max(sizes[source]) - min(sizes[source]) <= 1
            if source != "none":
                assert p.quota - 30 <= used[source] <= p.quota
        assert sizes["none"] == [1, 1]
        weights = [p.weight for p in by_source.values()]
        assert sum(weights) == pytest.approx(1) and entropy(weights) == pytest.approx(0.95 * math.log(3), abs=1e-6)
        if budget is None:
            assert min(map(min, sizes.values())) == 1
        out = mixed(docs, plans, blocks=16)
        assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_cases(spark):
    assert mixed(frame(spark, []), plan(frame(spark, []))).count() == 0
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "a b", "s"), (None, None, None), (2, "c " * 60_000, "t")]
    docs = frame(spark, rows)
    out = Counter((r.doc_id, r.source) for r in mixed(docs, plan(docs, repeats=2.0)).collect())
    assert out[None, None] == 1 and out[2, "t"] == 1 and out[1, "s"] == 4 and out[None, "s"] == 2
    with pytest.raises(ValueError):
        plan(docs, sources=2)


def test_query(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs = duckdb.sql(f"SELECT doc_id, source, text FROM '{sf}/documents.parquet'").fetchall()
    rows = {r.doc_id: r for r in op4_temperature_mixing(spark, sf).collect()}
    assert len(rows) == len(docs)
    total = Counter()
    for i, source, text in docs:
        n = len(text.split()) if text.isascii() else rows[i].n_tokens
        assert (rows[i].source, rows[i].n_tokens) == (source, n)
        total[source] += n
    a = exponent(list(total.values()), 0.95, 4.0)
    used = Counter()
    for r in rows.values():
        assert r.weight == pytest.approx(total[r.source] ** a / sum(t**a for t in total.values()), abs=1e-8)
        used[r.source] += r.n_tokens * r.copies
    longest = max(r.n_tokens for r in rows.values())
    assert all(r.quota - longest <= used[r.source] <= r.quota and r.copies >= 1 for r in rows.values())

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import pu_toxicity
from tidemark.llm.pu_toxicity import learn, op2_pu_toxicity, score

from .conftest import SMALL, prose


def test_query_on_held_out_rows(spark):
    sf = SMALL.replace("0.001", "0.1")
    got = {r.doc_id: r for r in op2_pu_toxicity(spark, sf).collect()}
    n = duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    assert len(got) == n
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    held = [(y, got[i].predicted) for i, y in labels if got[i].held_out]
    # About a quarter of the marks are noise that no text explains.
    hit = sum(y and p for y, p in held) / sum(y for y, _ in held)
    wrong = sum(p and not y for y, p in held) / sum(not y for y, _ in held)
    assert hit > 0.65 and wrong < 0.005


def _rows(n, bad):
    draw = random.Random(4)
    return [(i, prose(i, 30) + (" " + draw.choice(bad) if i % 5 == 0 else "")) for i in range(n)]


def test_learns_from_positives_and_unlabelled(spark, documents):
    docs = documents(_rows(400, ["vile", "scum"]) + [(1000, ""), (1001, None), (1002, "VILE!"), (1002, "VILE!")])
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 9) for i in range(400)], "doc_id long, toxic int, text int")
    out = {r.doc_id: r.toxicity for r in score(docs, *learn(docs, labels)).collect()}
    assert all((out[i] >= 0.5) == (i % 5 == 0) for i in range(400))
    assert out[1002] > 0.5 > out[1000] == out[1001]


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 0), (2, 0)]])
def test_without_positives_all_get_the_prior(spark, documents, labels):
    docs = documents([(1, "some text"), (2, ""), (None, None)])
    out = score(docs, *learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert {round(r.toxicity, 9) for r in out.collect()} == {0.001}
    assert score(documents([]), np.zeros(1 << 18), 0.0).count() == 0


def test_negative_risk_is_kept_from_below_zero():
    draw = np.random.default_rng(1)
    rows = [np.concatenate([draw.choice(50, 10, False), [60 if i < 40 else 61]]) for i in range(200)]
    at = np.arange(0, 201 * 11, 11)
    toxic = np.arange(200) < 20  # half of the positives are hidden among the unlabelled
    weights, bias = pu_toxicity.fit(toxic, at, np.concatenate(rows), 0.2)
    margin = np.array([weights[r].sum() + bias for r in rows])
    assert (margin[:40] > 0).all() and (margin[40:] < 0).all()

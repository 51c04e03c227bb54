from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm.flat_graph import STARTS, Search, build, medoids, split_centres, to_centres
from tidemark.llm.tables import table
from tidemark.llm.vector_dedup import near_vectors, op13_flat_graph_vectors

from .conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, shard long, home boolean, first string, m int, c long, vec string"


def brute(rows, cosine=0.95):
    """Sorted (vec_id, n_links, component, kept) by comparing all pairs."""
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    ids = [-1 if i is None else i for i, _ in rows]
    links = [0] * len(rows)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for sizes in {len(v) for (_, v), good in zip(rows, usable, strict=True) if good}:
        some = [k for k, (_, v) in enumerate(rows) if usable[k] and len(v) == sizes]
        x = np.array([rows[k][1] for k in some], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(x @ x.T >= cosine):
            if a != b:
                links[some[a]] += 1
                p, q = find(ids[some[a]]), find(ids[some[b]])
                root[max(p, q)] = min(p, q)
    out = []
    for i, n in zip(ids, links, strict=True):
        c = find(i)
        out.append((None if i == -1 else i, n, None if c == -1 else c, c == i))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def families(seed, sizes, dims=24, near=0.15):
    """Random directions, each with some copies that differ a little."""
    draw = np.random.default_rng(seed)
    out = []
    for size in sizes:
        base = draw.normal(size=dims)
        base /= np.linalg.norm(base)
        noise = draw.normal(size=(size, dims)) / np.sqrt(dims)
        out += (base + near * noise).tolist()
    order = draw.permutation(len(out))
    return [out[i] for i in order]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, True, "x", 2, 3, "y") for i, v in rows], SCHEMA).repartition(parts)


def test_odd_rows(spark):
    a = [1.0, 2.0, 3.0]
    rows = [
        (9, a),
        (4, [2.0, 4.0, 6.0]),
        (5, a),
        (5, [-1.0, 0.0, 0.0]),  # one id, two vectors: they join both groups
        (6, [-1.0, 0.0, 1e-3]),
        (None, [0.0, -1.0, 0.0]),
        (None, [0.0, -1.0, 0.0]),
        (7, [0.0, -1.0, 1e-3]),
        (1, None),
        (2, []),
        (3, [0.0, 0.0, 0.0]),
        (8, [1.0, None, 2.0]),
        (10, [float("nan"), 1.0, 2.0]),
        (11, [float("inf"), 1.0, 2.0]),
        (12, [1.0, 2.0]),
        (13, [1.0, 2.0]),
        (14, [1e-30, 2e-30, 3e-30]),
    ]
    assert result(near_vectors(frame(spark, rows))) == brute(rows)
    assert near_vectors(frame(spark, rows).limit(0)).isEmpty()


@pytest.mark.parametrize("sizes", [[1] * 150 + [2] * 40 + [9] * 10 + [300, 60], [700]])
def test_many_shards_equal_brute_force(spark, sizes):
    vectors = families(3, sizes)
    rows = list(enumerate(vectors + vectors[:40] * 3))
    out = near_vectors(frame(spark, rows, 6), limit=100)
    got, want = result(out), brute(rows)
    true, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert 0.97 * true <= found <= true
    # No link below the bound: never more links, never larger components.
    assert all(g[1] <= w[1] and (g[2] is None or g[2] >= w[2]) for g, w in zip(sorted(got), sorted(want), strict=True))
    assert sum(g[2] == w[2] for g, w in zip(sorted(got), sorted(want), strict=True)) >= 0.99 * len(want)
    # The audit's figure is near the true one.
    assert abs(out.first().recall - found / true) < 0.03


def test_whole_table(spark):
    base = [(r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").collect()]
    assert result(op13_flat_graph_vectors(spark, SMALL)) == brute(base)


def test_search_reaches_every_node():
    points = np.array(families(5, [1] * 400 + [80], 48))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph = build(points, 24, 32, 7)
    assert graph.shape == (480, 24) and (graph != np.arange(480)[:, None]).all()
    search = Search(points, graph, points)
    search.start(medoids(points, STARTS, 7))
    search.descend(32)
    search.widen(0.9)
    want = points @ points.T >= 0.95
    assert ((search.similarity >= 0.95) == want).mean() > 0.9999
    assert (search.similarity > -2).mean() < 0.9  # without a look at all


def test_centres_part_points_that_are_very_close():
    draw = np.random.default_rng(2)
    points = np.array([1.0, 2.0, 3.0]) + 1e-7 * draw.normal(size=(500, 3))
    cells = to_centres(points, split_centres(points, 10, 1)).argmin(1)
    assert np.bincount(cells, minlength=10).max() < 150

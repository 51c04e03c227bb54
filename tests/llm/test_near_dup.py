from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from tidemark.llm import near_dup
from tidemark.llm.graph import components
from tidemark.llm.near_dup import near_duplicates, op9_chosen_path_join

from .conftest import SMALL, prose


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(pairs):
    """(n_shingles, component) of every row, by comparing all documents that share a shingle."""
    sets = [shingles(t) for _, t in pairs]
    root = {i: i for i, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(pairs)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 75 * len(sets[x] | sets[y]):
                a, b = find(pairs[x][0]), find(pairs[y][0])
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for s, (i, _) in zip(sets, pairs, strict=True)]


def check(df, pairs):
    want = sorted((i, n, c, i == c) for (i, _), (n, c) in zip(pairs, brute(pairs), strict=True))
    assert sorted(tuple(r) for r in df.collect()) == want


def edited(text, seed, share):
    draw = random.Random(seed)
    return " ".join("x%d" % draw.randrange(10**6) if draw.random() < share else w for w in text.split())


def test_cases(documents):
    a = prose(1, 120)
    pairs = [
        (4, a),
        (9, a.upper().replace(" ", " \n\t")),
        (3, a + " one more tail"),
        (7, edited(a, 1, 0.02)),
        (8, edited(a, 2, 0.3)),
        (1, ""),
        (2, None),
        (5, " \n "),
        (6, "just three words"),
        (10, "JUST  three words"),
        (11, "just three"),
        (12, "é à\x0bü"),
        (13, "e " * 3000),
        (14, "e e e e e"),
    ]
    check(near_duplicates(documents(pairs)), pairs)


def test_chains_and_large_groups(documents, monkeypatch):
    base = prose(5, 150)
    pairs = [(i, edited(base, i, 0.012)) for i in range(70)]
    words = prose(6, 400).split()
    pairs += [(100 + i, " ".join(words[5 * i : 5 * i + 60])) for i in range(60)]
    pairs += [(300 + i, base[:200] + prose(50 + i, 60)) for i in range(40)]
    check(near_duplicates(documents(pairs), small=4), pairs)
    monkeypatch.setattr(near_dup, "_DEPTH", 1)
    check(near_duplicates(documents(pairs), small=4), pairs)


def test_pairs_below_the_limit_are_not_compared_in_full(documents, monkeypatch):
    words, draw, pairs = prose(7, 1100).split()[:600], random.Random(8), []
    for i in range(60):  # four runs of ten words are new in each, so two share some 0.68 of their shingles
        new = {10 * k + j for k in draw.sample(range(60), 4) for j in range(10)}
        pairs.append((i, " ".join(f"n{i}x{k}" if k in new else w for k, w in enumerate(words))))
    pairs += [(200, pairs[0][1] + " and a tail"), (201, pairs[50][1] + " one more")]
    sets = [shingles(t) for _, t in pairs]
    alike = [len(x & y) / len(x | y) for k, x in enumerate(sets) for y in sets[:k]]
    assert sum(0.6 < j < 0.75 for j in alike) > 1500 and sum(j >= 0.75 for j in alike) < 100
    compared, plain = [], near_dup.store

    def store(df, name):
        out = plain(df, name)
        if name == "tree_pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "store", store)
    check(near_duplicates(documents(pairs)), pairs)
    assert compared[0] < 300


def test_nodes_are_dealt_once_and_only_where_that_saves_comparisons(documents, monkeypatch):
    words, draw, pairs = prose(7, 1100).split()[:600], random.Random(8), []
    for i in range(60):  # two share some 0.68 of their shingles
        new = {10 * k + j for k in draw.sample(range(60), 4) for j in range(10)}
        pairs.append((i, " ".join(f"n{i}x{k}" if k in new else w for k, w in enumerate(words))))
    pairs += [(200, pairs[0][1] + " and a tail"), (201, pairs[40][1] + " one more")]
    rows, plain = {}, near_dup.store

    def store(df, name):
        out = plain(df, name)
        if name == "nodes_0":
            rows[name] = out.where("others > 16").count(), out.where("others > 4").count()
        elif name == "dealt_0":
            rows[name] = out.count()
        return out

    monkeypatch.setattr(near_dup, "store", store)
    check(near_duplicates(documents(pairs), small=4), pairs)
    many, more = rows["nodes_0"]
    assert 0 < many < more and rows["dealt_0"] == 4 * many  # nodes below may hold four times four others of a row


def test_parities_differ_in_no_more_bits_than_the_sets():
    draw = np.random.Generator(np.random.PCG64(9))
    one = np.unique(draw.integers(0, 1 << 63, 300, dtype=np.uint64))
    two = np.unique(np.concatenate([one[20:], draw.integers(0, 1 << 63, 15, dtype=np.uint64)]))
    three = np.unique(draw.integers(0, 1 << 63, 129, dtype=np.uint64))
    at = np.cumsum([0, len(one), 0, len(two), len(three)])
    x, none, y, z = near_dup._parities(np.concatenate([one, two, three]), at).to_pylist()
    bits = lambda p: sum((v % (1 << 64)) << (64 * i) for i, v in enumerate(p))
    assert [len(p) * 64 for p in (x, none, y, z)] == [1024, 256, 1024, 512] and not any(none)
    differing = (bits(x) ^ bits(y)).bit_count()
    assert 25 <= differing <= 35 and differing % 2 == 1
    for hashes, p in ((one, x), (three, z)):
        want = 0
        for h in hashes.tolist():
            want ^= 1 << (h % (64 * len(p)))
        assert bits(p) == want
    half = bits(x) % (1 << 512) ^ bits(x) >> 512
    want = 0
    for h in one.tolist():
        want ^= 1 << (h % 512)
    assert half == want


def test_rows_without_or_with_one_id(documents):
    a, b = prose(1, 80), prose(2, 80)
    pairs = [(None, a), (None, b), (5, a), (6, b), (7, a), (7, prose(3, 50)), (8, prose(3, 50)), (9, prose(4, 9))]
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(documents(pairs)).collect())
    assert got == [(0, None, True)] * 2 + [(i, None, False) for i in (5, 6, 7, 7, 8)] + [(9, 9, True)]


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    links += [(400, 500 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in list(root) if find(x) != x}


@pytest.mark.parametrize("sf", [SMALL, SMALL.replace("0.001", "0.01")])
def test_query_equals_brute_force(spark, sf):
    pairs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    check(op9_chosen_path_join(spark, sf), pairs)

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm.pattern_index import Blocks, WaveletTree, cubic_runs
from tidemark.llm.word_runs import op12_internal_pattern_runs, periodic_runs

from .conftest import SMALL, prose


def brute(words, least=24):
    """All maximal runs of three periods or more, by trying every period everywhere."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def left(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def some_words(draw):
    out = []
    for _ in range(draw.randint(0, 5)):
        base = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randint(1, 40))]
        if draw.random() < 0.4:
            # A period that is itself nearly periodic is the hard case.
            base = [0] * draw.randint(1, 20) + [1] * draw.randint(0, 3) + [0] * draw.randint(0, 12) + [2] * draw.randint(0, 2)
        out += (base * 200)[: draw.randint(1, 5 * len(base) + 3)]
    return out[:600]


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_symbols_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(120):
        docs = [some_words(draw) for _ in range(draw.randint(1, 4))]
        counts = [len(d) for d in docs]
        stops = np.cumsum(counts)
        firsts = stops - counts
        symbols = np.array([x + 100 * k for k, d in enumerate(docs) for x in d], np.int64)
        got = cubic_runs(symbols, np.repeat(firsts, counts), np.repeat(stops, counts))
        want = [(s + f, n, q) for f, d in zip(firsts.tolist(), docs, strict=True) for s, n, q in brute(d)]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_wavelet_tree_equals_sorting():
    draw = np.random.default_rng(1)
    values = draw.permutation(100)
    tree = WaveletTree(values)
    low = draw.integers(0, 100, 300)
    high = np.minimum(low + draw.integers(0, 40, 300), 100)
    bound = draw.integers(0, 140, 300)
    assert tree.below(low, high, bound).tolist() == [(values[a:b] < x).sum() for a, b, x in zip(low, high, bound, strict=True)]
    full = high > low
    low, high = low[full], high[full]
    n = (high - low) // 2
    assert tree.nth(low, high, n).tolist() == [np.sort(values[a:b])[k] for a, b, k in zip(low, high, n, strict=True)]


def test_extensions_equal_comparing():
    draw = random.Random(4)
    s = [draw.randrange(2) for _ in range(300)]
    blocks = Blocks(np.array(s), np.full(300, 300), 100)
    pairs = [sorted(draw.sample(range(300), 2)) for _ in range(200)] + [[0, 1], [298, 299]]
    i, j = np.array(pairs).T
    forward = [next((k for k in range(300 - b) if s[a + k] != s[b + k]), 300 - b) for a, b in pairs]
    backward = [next((k for k in range(a) if s[a - 1 - k] != s[b - 1 - k]), a) for a, b in pairs]
    assert blocks.forward(i, j).tolist() == forward
    assert blocks.backward(i, j).tolist() == backward


def test_cases(documents):
    spam = "buy now " * 12
    texts = [
        (1, spam + prose(1, 30)),
        (2, prose(2, 50)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "x " * 24),
        (7, "x " * 23),
        (8, "a b c d e f g h i " * 3),
        (8, "a b\x0bc " * 12),  # a no-break space is no blank, a vertical tab is one
        (None, spam),
        (None, spam),
        (9, " ".join(["a"] * 11 + ["b"]) + " " + " ".join(["a"] * 11 + ["b"]) + " " + " ".join(["a"] * 11 + ["b"])),
        (10, prose(3, 60_000) + " " + "so on and " * 2_000),
    ]
    out = sorted((repr(r) for r in ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(documents(texts)).collect())))
    want = []
    for doc_id, text in texts:
        words = split(text)
        runs = brute(words) if len(words) < 10_000 else [(60_000, 6_000, 3)]
        want.append(repr((doc_id, len(words), runs, left(words, runs))))
    assert out == sorted(want)
    assert periodic_runs(documents([(1, "x")]).limit(0)).isEmpty()


def test_query_equals_brute_force(spark):
    want = []
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall():
        words = split(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        digests = ["".join(f"{s},{m},{q}\n" for s, m, q in runs), left(words, runs)]
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(runs), *top, *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    out = op12_internal_pattern_runs(spark, SMALL)
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert out.columns == names
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
    assert sum(r[1] > 0 for r in want) >= 5

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from tidemark.llm.spelling import _Reducer, letter_runs, op11_reduced_alphabet_variants, spelling_variants

from .conftest import SMALL


def near(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    """Rows (word, n, n_near, form, form_n, root), by strings that lack one letter."""
    groups = {}
    for w in counts:
        for i in range(len(w)):
            groups.setdefault(("replaced", len(w), w[:i], w[i + 1 :]), set()).add(w)
            groups.setdefault(("shorter", w[:i] + w[i + 1 :]), set()).add(w)
    around = {w: set() for w in counts}
    for key, members in groups.items():
        for w in members:
            if key[0] == "replaced":
                around[w] |= members - {w}
            elif key[1] in counts:
                around[w].add(key[1])
                around[key[1]].add(w)
    out = {}
    for w, n in counts.items():
        form = min(around[w], key=lambda x: (-counts[x], x), default=None)
        form = form if form is not None and counts[form] >= ratio * n and counts[form] else None
        out[w] = (n, len(around[w]), form, counts.get(form))
    rows = []
    for w, values in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        rows.append((w, *values, root))
    return sorted(rows)


def frame(spark, counts):
    rows = [(w, n, 1, "x", "y") for w, n in counts]
    return spark.createDataFrame(rows, "word string, n long, id long, near string, root string").repartition(3)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_neighbourhoods_meet_once():
    draw = random.Random(2)
    for words in (5, 10**6):
        reducer = _Reducer(words)
        for _ in range(300):
            a = "".join(draw.choice("abcdefxyzé\U0001f600") for _ in range(draw.randint(1, 12)))
            i = draw.randrange(len(a) + 1)
            b = draw.choice([a[:i] + "q" + a[i:], a[:i] + a[i + 1 :], a[:i] + "q" + a[i + 1 :]])
            if a == b:
                continue

            def keys(w):
                letters = np.frombuffer(w.encode("utf-32-le"), np.uint32).reshape(1, len(w))
                steps = [k for _, part in reducer.replaced(letters) for k in part.tolist()]
                shorter = reducer.shortened(letters)[1].tolist() if w else []
                return reducer.own(letters)[0], steps, shorter

            (own_a, steps_a, less_a), (own_b, steps_b, less_b) = keys(a), keys(b)
            met = [own_a == own_b, *(k == own_b for k in steps_a + less_a), *(k == own_a for k in steps_b + less_b)]
            assert sum(met) == 1


def test_cases(spark):
    long = "ab" * 3000
    counts = [
        ("", 5),
        ("a", 50),
        ("b", 50),
        ("ab", 500),
        ("colour", 1000),
        ("color", 100_000),
        ("colr", 100),
        ("colurs", 10),
        ("colours", 99),
        ("colours", 1),
        ("naïve", 3),
        ("naive", 30),
        ("na\U0001f600ve", 300),
        ("zero", 0),
        ("zera", None),
        (long, 2),
        (long[:-1] + "x", 20),
        (long[1:], 200),
        (long[::-1], 7),
        (None, 9),
    ]
    totals = Counter()
    for w, n in counts:
        if w is not None:
            totals[w] += n or 0
    assert result(spelling_variants(frame(spark, counts))) == brute(dict(totals))
    assert spelling_variants(frame(spark, counts).limit(0)).isEmpty()


def test_words_of_one_reduced_string(spark):
    """Few letters, so many words share a reduced string; every pair is still found."""
    draw = random.Random(3)
    counts = {"".join(draw.choice("ab") for _ in range(draw.choice([9, 10]))): draw.randint(1, 400) for _ in range(700)}
    assert result(spelling_variants(frame(spark, counts.items()), ratio=3)) == brute(counts, 3)


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def test_runs_of_letters(documents):
    draw = random.Random(5)
    texts = [(i, " ".join("".join(draw.choice("aBÀÿz") for _ in range(draw.randint(5, 9))) for _ in range(60))) for i in range(20)]
    texts += [(None, "straßenbahn ÉCLAIRS×plus"), (3, None), (3, ""), (4, "x" * 100_000 + "1" + "Ångström-units")]
    got = {r.word: r.n for r in letter_runs(documents(texts)).collect()}
    assert got == dict(words_of(texts))


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    counts = {w: n for w, n in words_of(rows).items() if n >= 2}
    out = op11_reduced_alphabet_variants(spark, SMALL)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(counts)
    assert result(out) == want
    assert sum(r[3] is not None for r in want) > 0
    some = random.Random(1).sample(sorted(counts), 40)
    assert all(sum(near(w, x) for x in counts) == r[2] for w in some for r in want if r[0] == w)

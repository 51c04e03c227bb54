from __future__ import annotations

import random
import re

import duckdb
import pytest

from tidemark.llm.decontaminate import Matcher, find, myers, normal, op6_pigeonhole_decontamination

from .conftest import SMALL, prose


def distance(pattern, text):
    """The least edit distance of ``pattern`` to any part of ``text``, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def words(text):
    return " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())).encode().decode("latin-1")


def test_myers_against_the_whole_table():
    draw = random.Random(2)
    for _ in range(80):
        text = "".join(draw.choices("abc ", k=draw.randrange(0, 90)))
        pattern = "".join(draw.choices("abc ", k=draw.randrange(1, 70)))
        got, end = myers(pattern, text)
        assert got == distance(pattern, text)
        assert min(distance(pattern, text[:end]), len(pattern)) == got


def edited(text, draw, n):
    chars = list(text)
    for _ in range(n):
        at = draw.randrange(len(chars))
        chars[at : at + draw.randrange(2)] = draw.choice(["", "q", "zx"])
    return "".join(chars)


def test_matches_equal_the_whole_table():
    draw = random.Random(5)
    items = [(i, normal(prose(i, draw.randrange(6, 30)))) for i in range(12)]
    matcher = Matcher(items, 0.08)
    seen = 0
    for _ in range(14):
        item, text = draw.choice(items)
        raw = prose(1000 + item, 20) + " " + edited(text, draw, draw.randrange(0, 12)) + " " + prose(2000 + item, 10)
        want = {i: d for i, t in items if (d := distance(t, words(raw))) <= int(len(t) * 0.08)}
        assert {m["item_id"]: m["distance"] for m in matcher(raw)} == want
        for m in matcher(raw):
            part = words(raw)[m["start"] : m["stop"]]
            assert abs(len(part) - len(dict(items)[m["item_id"]])) <= m["distance"]
        seen += len(want)
    assert seen > 5


def test_cases(spark, documents):
    item = "The Quick brown-fox jumps over 13 lazy dogs; é à."
    rows = [(1, item), (2, "short"), (3, None), (None, "An item that has no id but a text"), (1, item)]
    bench = spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, matches int")
    docs = documents(
        [
            (1, "x " + item.upper().replace(" ", "\n\n") + " y"),
            (2, "short"),
            (3, None),
            (4, ""),
            (None, "an item, that HAS no id but a text"),
            (5, "w " * 100_000 + item),
            (6, "the quick brown fox jumps over 14 lazy dogs é à"),
            (6, "the quick brown fox"),
        ]
    )
    for block in (1 << 22, 40):
        got = sorted(((r.doc_id or 0), [(m.item_id, m.distance) for m in r.matches]) for r in find(docs, bench, block=block).collect())
        assert got == [
            (0, [(None, 0)]), (1, [(1, 0)] * 2), (2, []), (3, []), (4, []), (5, [(1, 0)] * 2), (6, []), (6, [(1, 1)] * 2),
        ]
    assert find(documents([]), bench).count() == 0
    assert [r.matches for r in find(documents([(1, "a")]), bench.limit(0)).collect()] == [[]]


@pytest.mark.parametrize("sf", [SMALL.replace("0.001", "0.01")])
def test_query(spark, sf):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall())
    rows = {r.doc_id: r for r in op6_pigeonhole_decontamination(spark, sf).collect()}
    assert set(rows) == set(texts)
    whole = {(d, i) for d, t in texts.items() for i, x in items.items() if words(x) in words(t)}
    assert whole == {(d, i) for d, r in rows.items() for i, k in zip(r.item_ids, r.distances, strict=True) if k == 0}
    assert all(r.contaminated == bool(r.item_ids) for r in rows.values()) and len(whole) > 5


def test_short_items_have_a_column_of_their_own(documents, spark):
    rows = [(1, "Short!"), (2, "short cut"), (3, "short"), (4, "?"), (None, "cut x")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = documents([(1, "a SHORT  cut x"), (2, "shorter cuts"), (3, "short"), (4, None), (5, "?")])
    for block in (1 << 22, 7):
        got = {r.doc_id: (sorted(r.short_items, key=str), r.matches) for r in find(docs, bench, block=block).collect()}
        assert got == {1: ([1, 2, 3, None], []), 2: ([], []), 3: ([1, 3], []), 4: ([], []), 5: ([], [])}

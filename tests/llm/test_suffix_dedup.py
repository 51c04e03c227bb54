from __future__ import annotations

import hashlib

import duckdb
import pytest

from tidemark.llm.suffix_dedup import op1_suffix_array_dedup, remove_repeats

from .conftest import SMALL, prose


def brute(pairs, length=100, key=lambda p: (p[0] is not None, p[0] or 0)):
    """(n_bytes, spans, kept) by (doc_id, text), with every string looked up in a set."""
    seen, out = set(), {}
    for doc, text in sorted(set(pairs), key=key):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        spans, i = [], 0
        while i < len(data):
            j = i
            while j < len(data) and gone[j]:
                j += 1
            if j > i:
                spans.append((i, j))
            i = max(j, i + 1)
        out[doc, text] = len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out


def check(documents, pairs):
    got = sorted(
        (r.doc_id is not None, r.doc_id or 0, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
        for r in remove_repeats(documents(pairs)).collect()
    )
    want = brute(pairs)
    assert got == sorted((i is not None, i or 0, *want[i, t]) for i, t in pairs)


def test_cases(documents):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    pairs = [
        (5, a),
        (5, a),
        (2, a + " é " + b),
        (9, b[7:200] + c + b[100:350]),
        (7, "ab" * 400),
        (8, "ab" * 300),
        (1, ""),
        (3, None),
        (None, c[:150]),
        (4, "x" * 99),
        (6, "y" * 100),
        (10, "y" * 101),
        (11, c[30:128] + "!" + c[129:300]),
    ]
    check(documents, pairs)


def test_many_copies_and_passages(documents):
    line = prose(9, 20)
    pairs = [(i, prose(100 + i // 4, 30) + line + prose(200 + i, 20)) for i in range(60)]
    check(documents, pairs)


def test_long_text_is_cut_into_segments(documents, monkeypatch):
    from tidemark.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 700)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 300)
    roller = suffix_dedup.Roller(1)
    import numpy as np
    import pyarrow as pa

    text = prose(4, 500)
    data, offsets = suffix_dedup.text_bytes(pa.array([text, "short", text[:650]]))
    doc, start, count, _, _ = suffix_dedup._phrases(data, offsets, 100, 48, roller)
    covered = sorted((d, s + i) for d, s, c in zip(doc, start, count, strict=True) for i in range(c))
    assert covered == [(0, i) for i in range(len(text) - 99)] + [(2, i) for i in range(551)]
    assert np.all(count <= 53)


def test_thousands_of_rows_without_id(documents):
    """Different texts that share no more than a missing id or one id go by their hashes."""
    same = prose(1, 40)
    pairs = [(None, f"{i:05d}" + "abcdefghij"[i % 10] * (i % 200)) for i in range(12_000)]
    pairs += [(3, f"{i} {prose(i, 25)}") for i in range(300)] + [(9, same), (9, same + "x"), (10, same)]
    df = documents(pairs, 8)
    hashes = {r.text: (r.h1, r.h2) for r in df.selectExpr("text", "xxhash64(text, 1) AS h1", "xxhash64(text, 2) AS h2").collect()}
    want = brute(pairs, key=lambda p: (p[0] is not None, p[0] or 0, hashes[p[1]]))
    got = sorted((r.doc_id or 0, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in remove_repeats(df).collect())
    assert got == sorted((i or 0, *want[i, t]) for i, t in pairs)


def test_empty_table(documents):
    assert remove_repeats(documents([])).count() == 0


@pytest.mark.parametrize("sf", [SMALL, SMALL.replace("0.001", "0.01")])
def test_query_equals_brute_force(spark, sf):
    pairs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    want = {
        (i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for (i, _), (n, spans, kept) in brute(pairs).items()
    }
    assert {tuple(r) for r in op1_suffix_array_dedup(spark, sf).collect()} == want

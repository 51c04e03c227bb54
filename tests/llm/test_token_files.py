from __future__ import annotations

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.re_pair import Grammar, compress
from tidemark.llm.tables import real_id
from tidemark.llm.token_files import decode, encode, op7_re_pair_token_files, starts

from .conftest import SMALL, prose


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def brute(pairs, tokenizer):
    out, start = [], 0
    for doc, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, (p[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [0, 1, 2, 257, 5000, 60_000])
def test_grammar_round_trip(size):
    draw = np.random.default_rng(size)
    phrases = [draw.integers(2, 5000, draw.integers(1, 9)) for _ in range(50)]
    ids = np.concatenate([phrases[i] for i in draw.integers(0, 50, size)] + [np.full(size % 3, 7)])[:size]
    ids[draw.random(len(ids)) < 0.01] = 1
    data = compress(ids, 49_408, 1)
    grammar = Grammar(data)
    assert np.array_equal(grammar.all(), ids) and grammar.size == len(ids)
    for a, b in draw.integers(0, size + 2, (40, 2)):
        assert np.array_equal(grammar.part(a, b), ids[a:b])
    if size >= 5000:
        assert len(data) < len(ids)


def test_runs_of_one_id():
    for n in range(30, 40):
        ids = np.concatenate([np.full(n, 9), [1], np.full(2 * n, 9)])
        assert np.array_equal(Grammar(compress(ids, 100, 1)).all(), ids)


def test_cases(documents, tokenizer):
    pairs = [
        (3, "It's Été-là, ÉTÉ ﬁne ‘quoted’ 1234 a1b2 don't I'LL x'sy"),
        (1, ""),
        (2, None),
        (None, "no id"),
        (7, "<|endoftext|> a<|startoftext|>b <|endoftext|"),
        (9, "é ́e Å\n̊ x y z\x1f\x0b\x85 ÀÈß İI ΑΣ ς Ωµªº"),
        (9, "tab\tand\r\nlines\n\n  more   blanks "),
        (9, "tab\tand\r\nlines\n\n  more   blanks "),
        (12, "W" * 3000 + "é" * 500 + "!" * 400 + "日本語テキスト😀"),
        (13, prose(1, 4000)),
    ] + [(20 + i, prose(i, 50).title() + "." * (i % 5) + ",;") for i in range(20)]
    shards = encode(documents(pairs), size=700)
    rows = decode(shards).join(starts(shards), "shard").select(real_id("d"), "first", "at", "n", "crc").collect()
    got = sorted(((r[0], r[1] + r[2], r[3], r[4]) for r in rows), key=lambda r: r[1])
    assert got == brute(pairs, tokenizer)
    assert shards.count() > 5
    empty = encode(documents([]))
    assert decode(empty).join(starts(empty), "shard").count() == 0


def test_query_equals_brute_force(spark, tokenizer):
    sf = SMALL.replace("0.001", "0.01")
    pairs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in op7_re_pair_token_files(spark, sf).collect()), key=lambda r: r[1])
    assert got == brute(pairs, tokenizer)

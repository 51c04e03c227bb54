from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm import quality_rules
from tidemark.llm.quality_rules import judge, judge_corpus, op3_ngram_ratio_rules, ratios

from .conftest import SMALL, prose

GAPS = " \t\n\x0b\x0c\r"


def base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if line.strip(GAPS)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def columns(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_cases(spark, documents):
    a = prose(1, 40)
    texts = ["", None, " \n\t ", "one", a, a + "\n" + a, "é 😀# " * 30, "a\n \na\n a\n\x0b", a[:100] + "\xa0b" + a[100:]]
    texts += ["w " * 5000, prose(2, 3000) + " " + prose(2, 9), " ".join("abcdefgh") + " x " + " ".join("abcdefgh")]
    texts += ["$$$ ### " + prose(3, 30).upper()]
    pairs = list(enumerate(texts)) + [(None, a), (4, a)]
    docs = documents(pairs)
    trusted = spark.createDataFrame([(4, 1), (10, 2), (None, 3)], "doc_id long, text int")
    rows = judge(docs, ratios(docs, trusted)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *map(str, x[1:]))
    assert sorted(((r.doc_id, *columns(r)) for r in rows), key=key) == sorted(((i, *base(t)) for i, t in pairs), key=key)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[0] == scores[1] == 0
    assert all(r.kept == (not r.base_failed and r.score >= -0.2) for r in rows)


@pytest.mark.parametrize("pairs", [[], [(1, None), (2, "")]])
def test_without_words_or_trusted_rows(spark, documents, pairs):
    docs = documents(pairs)
    none = spark.createDataFrame([], "doc_id long")
    assert [r.kept for r in judge(docs, ratios(docs, none)).collect()] == [False] * len(pairs)


def test_query(spark):
    sf = SMALL.replace("0.001", "0.01")
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = op3_ngram_ratio_rules(spark, sf).collect()
    assert {r.doc_id: columns(r) for r in rows} == {i: base(t) for i, t in texts.items()} and len(rows) == len(texts)
    judged = [(quality[r.doc_id], r.kept) for r in rows if r.doc_id in quality and not r.base_failed]
    assert all(kept for good, kept in judged if good)
    bad = [kept for good, kept in judged if not good]
    assert sum(bad) < 0.4 * len(bad)


def test_score_is_the_mean_log_ratio(spark, documents):
    docs = documents([(1, "a b " * 15), (2, "c d " * 15)])
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    low = judge(docs, ratios(docs, trusted, buckets=64), buckets=64).collect()
    ratio = {r.doc_id: r.score for r in low}
    assert ratio[1] > 0.2 and ratio[2] < -1


def test_verdicts_hold_as_the_corpus_grows(spark):
    sf = SMALL.replace("0.001", "0.1")
    every, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    for parts in (16, 1):
        docs = every.where(f"pmod(xxhash64(doc_id), {parts}) = 0")
        rows = judge(docs, ratios(docs, labels.where("quality = 1"))).collect()
        judged = [(quality[r.doc_id], r.kept) for r in rows if r.doc_id in quality and not r.base_failed]
        good, low = ([kept for q, kept in judged if q == wanted] for wanted in (1, 0))
        assert sum(good) >= 0.99 * len(good) > 0 and sum(low) <= 0.03 * len(low) and low


def test_scores_equal_a_plain_version(spark, documents, monkeypatch):
    monkeypatch.setattr(quality_rules, "_SLOTS", 8)  # few places, so that most n-grams join the table
    pairs = [(i, prose(i % 7, 30 + i) + " the end" * (i % 3)) for i in range(20)] + [(3, prose(3, 33)), (None, "the end")]
    good = {0, 3, 5, 11}
    grams = lambda t: (w := t.split()) + list(zip(w, w[1:]))
    all_, some = Counter(), Counter()
    for i, t in pairs:
        all_.update(grams(t))
        some.update(grams(t) if i in good else [])
    share = some.total() / all_.total()
    want = sorted(sum(math.log((some[g] + 1) / (all_[g] * share + 1)) for g in grams(t)) / len(grams(t)) for _, t in pairs)
    docs = documents(pairs)
    rows = judge(docs, ratios(docs, spark.createDataFrame([(i,) for i in good], "doc_id long"))).collect()
    assert sorted(r.score for r in rows) == pytest.approx(want)


def test_all_trusted_rows_count(spark):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('w', id, ' x') AS text")
    assert ratios(docs, docs.select("doc_id")).where("abs(ratio) > 1e-9").count() == 0


@pytest.mark.parametrize("rounds", [1, 3])
def test_a_corpus_judged_by_itself(spark, documents, monkeypatch, rounds):
    monkeypatch.setattr(quality_rules, "_SLOTS", 16)
    monkeypatch.setattr(quality_rules, "_LONG", 10_000)
    monkeypatch.setattr(quality_rules, "_IDS", 0 if rounds == 3 else 1 << 20)
    pairs = [(i, prose(i % 7, 30 + i) + " the end" * (i % 3)) for i in range(60)] + [(3, prose(3, 33)), (None, "the end")]
    pairs += [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "w " * 20_000), (9, "w " * 20_000), (None, "the end")]
    docs = documents(pairs)
    for good in ([0, 3, 5, 9, 11], []):
        trusted = spark.createDataFrame([(i,) for i in [*good, *good, None]], "doc_id long")
        want = judge(docs, ratios(docs, trusted)).collect()
        got = judge_corpus(docs, trusted, rounds=rounds).collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.score)
        want, got = sorted(want, key=key), sorted(got, key=key)
        assert [r.score for r in got] == pytest.approx([r.score for r in want])
        assert [(r.doc_id, *columns(r), r.kept) for r in got] == [(r.doc_id, *columns(r), r.kept) for r in want]


def test_an_empty_corpus_judged_by_itself(spark, documents):
    none = spark.createDataFrame([], "doc_id long")
    assert judge_corpus(documents([]), none).count() == 0
    assert [r.score for r in judge_corpus(documents([(1, None)]), none).collect()] == [0]


def test_scans_of_a_corpus_are_compiled(spark, documents):
    rows = quality_rules._marked(documents([(1, "a b"), (2, None)]), spark.createDataFrame([(1,)], "doc_id long"))
    plan = quality_rules._exploded(rows)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Generate posexplode" in plan


def test_words_and_windows_of_odd_texts(spark, documents):
    eight = "a b c d e f g h"
    texts = ["\ta\x0bb\x0cc\rd\n\n e  \u00a0f ", "\n", "\r\n", "x\x1cy", "\x1f z", f"{eight}\t{eight}", f"{eight} {eight[:-2]}"]
    texts += ["a b c " * 5, " ".join(f"{i} {eight[:13]} {i}" for i in range(9)), "q " * 8, "q " * 9, "q " * 7]
    texts += [f"{eight} 1 {eight[2:]} i 2 {eight}", f"1 {eight[:7]} 2 {eight[:7]} {eight[8:]} 3 {eight[8:]}"]
    trusted = spark.createDataFrame([(3,)], "doc_id long")
    rows = judge_corpus(documents(list(enumerate(texts))), trusted, rounds=1).collect()
    assert {r.doc_id: columns(r) for r in rows} == {i: base(t) for i, t in enumerate(texts)}

from __future__ import annotations

import random
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import schemas
from tidemark.operators import bigrams, transitions, walks
from tidemark.plans import phrases
from tidemark.session import materialize
from tidemark.sources import files

RAW = [
    "financial analysis\t1990\t70\t1\t1",
    "financial analysis\t1991\t60\t1\t1",
    "financial 1990s\t1990\t9\t1\t1",
    "single\t1990\t9\t1\t1",
    "a b c\t2000\t5\t1\t1",
    'say "hi\t2000\t5\t1\t1',
    "x y\t2000\t3\t1\t1",
    "null nan\t2000\t2\t1\t1",
    "x y\t2001\t4\t1\t1",
]


@pytest.fixture
def corpus(spark, tmp_path):
    path = tmp_path / "corpus-2gram-7.csv"
    path.write_text("\n".join(RAW) + "\n")
    return files.read_ngrams(spark, str(path))


def test_clean_counts(corpus, rows):
    assert rows(phrases.corpus_counts(corpus)) == [
        ("financial", "analysis", 130),
        ("null", "nan", 2),
        ("x", "y", 7),
    ]


def test_first_two_words_variant(corpus, rows):
    assert ("a", "b", 5) in rows(phrases.corpus_counts(corpus, first_two=True))


def test_final_newline_is_not_a_letter(spark):
    df = spark.createDataFrame([("a b\n", 1), ("a b", 1)], "bi_gram string, match_count bigint")
    assert bigrams.clean(df).count() == 1


def test_no_usable_row_gives_an_empty_result(spark):
    df = spark.createDataFrame([("1 2", 1)], "bi_gram string, match_count bigint")
    assert phrases.corpus_counts(df).count() == 0


def test_counts_survive_the_tsv(corpus, spark, rows, tmp_path):
    counts = phrases.corpus_counts(corpus)
    files.write_tsv(counts, str(tmp_path / "one"))
    files.write_tsv(counts, str(tmp_path / "two"))
    both = files.read_counts(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert rows(transitions.totals(both)) == [
        ("financial", "analysis", 260),
        ("null", "nan", 4),
        ("x", "y", 14),
    ]


def test_zip_archives(spark, rows, tmp_path):
    for number in (7, 8):
        with zipfile.ZipFile(tmp_path / f"corpus-2gram-{number}.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"corpus-2gram-{number}.csv", "\n".join(RAW) + "\n")
    read = files.read_zip_ngrams(spark, str(tmp_path / "*.zip"))
    assert read.schema.fieldNames() == ["file_no", "line_no", *schemas.NGRAM.fieldNames()]
    assert read.count() == 2 * len(RAW)
    assert rows(read.where("line_no = 6 and file_no = 8"), "bi_gram", "match_count") == [('say "hi', 5)]
    runs = bigrams.run_totals(read, ["line_no"], F.floor(F.col("line_no") / 2))
    assert rows(runs.where("file_no = 7").select("line_no", "gram0", "gram1", "matchcount")) == [
        (1, "financial", "analysis", 130),
        (5, "a", "b", 5),
        (7, "x", "y", 3),
        (8, "null", "nan", 2),
        (9, "x", "y", 4),
    ]


def _runs_by_hand(lines):
    """Consecutive equal first-two-word keys per file, walked in order."""
    out, open_runs = [], {}
    for file_no, line_no, bi_gram, n in lines:
        words = bi_gram.split(" ")
        key = (words[0], words[1] if len(words) > 1 else None)
        run = open_runs.get(file_no)
        if run and run[1] == key:
            run[2] += n
        else:
            run = [line_no, key, n]
            open_runs[file_no] = run
            out.append((file_no, run))
    ok = lambda w: w is not None and w.isascii() and w.isalpha()
    return sorted((f, r[0], *r[1], r[2]) for f, r in out if ok(r[1][0]) and ok(r[1][1]))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_run_totals_against_a_walk_through_the_lines(spark, rows, piece):
    rng = random.Random(piece)
    keys = ["a b", "a b c", "a c", "single", "x1 y", "q r"]
    lines, line_no = [], {0: 0, 1: 0}
    for _ in range(120):
        file_no, key = rng.choice([0, 0, 1]), rng.choice(keys)
        for _ in range(rng.choice([1, 1, 2, 9])):
            line_no[file_no] += rng.choice([1, 3])
            lines.append((file_no, line_no[file_no], key, rng.randint(1, 9)))
    df = spark.createDataFrame(lines, "file_no int, line_no bigint, bi_gram string, match_count bigint")
    got = bigrams.run_totals(df.repartition(5), ["line_no"], F.floor(F.col("line_no") / piece))
    assert sorted(tuple(r) for r in got.collect()) == _runs_by_hand(lines)


def test_lines_without_two_words_are_stored_at_edges_only(spark, monkeypatch):
    stored = {}

    def keep(df, name):
        stored[name] = (df._jdf.queryExecution().optimizedPlan().toString(), materialize(df, name))
        return stored[name][1]

    monkeypatch.setattr(bigrams, "materialize", keep)
    pairs = ["a b", "x1 y", "x2 y", None, "a b", "single", "c d", "c d e", "4"]
    lines = [(0, i, pair, 1) for i, pair in enumerate(pairs * 10)]
    df = spark.createDataFrame(lines, "file_no int, line_no bigint, bi_gram string, match_count bigint")
    got = bigrams.run_totals(df, ["line_no"], F.floor(F.col("line_no") / 45))
    assert [tuple(r)[1:] for r in got.orderBy("line_no").limit(3).collect()] == [(0, "a", "b", 1), (4, "a", "b", 1), (6, "c", "d", 2)]
    assert got.count() == 30
    # The last line of each of the two pieces has no second word.
    assert stored["runs"][1].where("_pair = ''").count() == 2
    # Lines move with nothing beside their own columns.
    assert "struct(" not in stored["runs"][0]


def test_runs_equal_group_totals_on_sorted_input(spark, rows):
    data = sorted((f"{a} {b}", y, 1) for a in "pqr" for b in "stu" for y in range(5))
    df = spark.createDataFrame(
        [(0, i, *d) for i, d in enumerate(data)], "file_no int, line_no int, bi_gram string, year int, match_count bigint"
    )
    runs = bigrams.run_totals(df, ["line_no"], F.floor(F.col("line_no") / 4))
    assert rows(runs, "gram0", "gram1", "matchcount") == rows(phrases.corpus_counts(df))


@pytest.fixture(scope="module")
def totals(spark):
    rng = random.Random(1)
    words = [a + b for a in "abcdefgh" for b in "xyz"]
    pairs = {("the", w + s): rng.randint(1, 9) for w in words for s in ("", "q", "qq")}
    pairs |= {(w, rng.choice(["the", *words])): rng.randint(1, 50) for w in words}
    return spark.createDataFrame([(*k, n) for k, n in pairs.items()], "gram0 string, gram1 string, n bigint").persist()


def _plain_cdf(totals):
    w = Window.partitionBy("gram0").orderBy("gram1")
    return totals.select(
        "gram0",
        "gram1",
        "n",
        (F.sum("n").over(w) - F.col("n")).alias("cum_lo"),
        F.sum("n").over(w).alias("cum_hi"),
        F.sum("n").over(Window.partitionBy("gram0")).alias("total"),
        F.count("*").over(Window.partitionBy("gram0")).alias("size"),
    )


def test_cumulative_equals_one_window(totals, rows):
    assert rows(transitions.cumulative(totals)) == rows(_plain_cdf(totals))


def test_probabilities_sum_to_one(totals, rows):
    p = transitions.probabilities(totals)
    assert p.count() == totals.count()
    sums = p.groupBy("gram0").agg(F.round(F.sum("probability"), 9).alias("s"))
    assert {r.s for r in sums.collect()} == {1.0}


def test_transitions_example(spark, rows):
    counts = spark.createDataFrame([("a", "b", 3), ("a", "c", 1)], schemas.BIGRAM_COUNT)
    assert rows(transitions.successors(counts, "a")) == [("b", 3, 0.75), ("c", 1, 0.25)]
    assert rows(transitions.successors(counts, "a.*")) == []
    t = transitions.cumulative(transitions.totals(counts))
    assert rows(t.drop("size")) == [("a", "b", 3, 0, 3, 4), ("a", "c", 1, 3, 4, 4)]


def _walk_by_hand(totals, seeds, max_words, seed):
    import hashlib

    successors = {}
    for g0, g1, n in sorted(tuple(r) for r in totals.collect()):
        successors.setdefault(g0, []).append((g1, n))
    phrases_by_id = {}
    for walk_id, word in seeds:
        path = [word]
        while len(path) < max_words and path[-1] in successors:
            options = successors[path[-1]]
            digest = hashlib.md5(f"{seed}|{walk_id}|{len(path)}".encode()).hexdigest()
            left = int(digest[:13], 16) % sum(n for _, n in options)
            for word, n in options:
                if left < n:
                    path.append(word)
                    break
                left -= n
        phrases_by_id[walk_id] = (len(path), " ".join(path))
    return phrases_by_id


@pytest.mark.parametrize("slot_rows", [64, 4])
def test_walk_against_a_hand_walk(spark, totals, slot_rows):
    seeds = [(i, "the" if i % 3 else "ax") for i in range(60)] + [(60, "unknown"), (61, "")]
    got = walks.walk(totals, spark.createDataFrame(seeds, "walk_id bigint, word string"), 7, 3, slot_rows)
    assert {r.walk_id: (r.words, r.phrase) for r in got.collect()} == _walk_by_hand(totals, seeds, 7, 3)


def test_one_word_walk_is_the_seed(spark, totals, rows):
    seeds = spark.createDataFrame([(1, "the")], "walk_id bigint, word string")
    assert rows(walks.walk(totals, seeds, 1)) == [(1, 1, "the")]


def test_walk_differs_by_seed_and_repeats(spark, totals, rows):
    seeds = spark.createDataFrame([(i, "the") for i in range(30)], "walk_id bigint, word string")
    first = rows(walks.walk(totals, seeds, 5, 1))
    assert first == rows(walks.walk(totals, seeds, 5, 1))
    assert first != rows(walks.walk(totals, seeds, 5, 2))


def test_a_frequent_word_has_slots_of_its_share(spark):
    totals = spark.createDataFrame([("a", "b", 10**6), ("b", "a", 1)], "gram0 string, gram1 string, n bigint")
    whole = 10**6 + 1
    widths = {r.word: r.width for r in walks.word_ranges(totals, whole).collect()}
    assert widths["a"] * 900 < 10**6 and widths["b"] == 1
    index = walks.walk_index(totals, walks.word_ranges(totals, whole), whole)
    assert index.where("gram0 = 'a'").count() > 900

"""Groups of spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols. Two words one edit apart reduce to strings that are equal
or one edit apart, so every word's reduced string, all strings one replacement from it, and all
that lack one of its symbols are joined with the reduced vocabulary; strings with one symbol
more are the same step seen from the longer word. Of two strings one replacement apart, the
one with the lower symbol names the pair, so each pair of words is met once. The number of
symbols falls with the length of words and rises with the size of the vocabulary, which keeps
the words that meet by chance to a few for each word. Every pair is verified on the words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .rolling import mix
from .tables import complete, store, table

_SPARE = 256  # reduced strings there are for each word of the vocabulary
_SYMBOLS = (4, 64)  # the smallest and the largest alphabet
_ROWS = 1 << 18  # keys made at a time
_A_TO_Z = "abcdefghijklmnopqrstuvwxyz"


class _Reducer:
    """Keys of reduced strings, for a vocabulary of a certain size."""

    def __init__(self, words: int):
        self._words = words
        self._factors = np.zeros(0, np.uint64)

    def factors(self, n: int) -> np.ndarray:
        """Odd factors of the places of a string."""
        if len(self._factors) < n:
            draw = np.random.Generator(np.random.PCG64(17))
            self._factors = draw.integers(0, 1 << 63, max(n, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        return self._factors[:n]

    def symbols(self, length: int) -> int:
        """Symbols of the alphabet for reduced strings of a length."""
        least, most = _SYMBOLS
        return min(most, max(least, math.ceil((_SPARE * self._words) ** (1 / max(length, 1)))))

    def reduce(self, letters: np.ndarray, length: int) -> np.ndarray:
        return (mix(letters.astype(np.uint64) + np.uint64(1)) >> np.uint64(20)) % np.uint64(self.symbols(length)) + np.uint64(1)

    @staticmethod
    def key(sums: np.ndarray, length: int) -> np.ndarray:
        return mix(sums + np.uint64(length * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.int64)

    def own(self, letters: np.ndarray) -> np.ndarray:
        length = letters.shape[1]
        return self.key((self.reduce(letters, length) * self.factors(length)).sum(1, dtype=np.uint64), length)

    def replaced(self, letters: np.ndarray):
        """(rows, keys) of all strings where one symbol is replaced by a higher one."""
        length = letters.shape[1]
        symbols, factors = self.reduce(letters, length), self.factors(length)
        sums = (symbols * factors).sum(1, dtype=np.uint64)
        for step in range(1, self.symbols(length)):
            row, place = np.nonzero(symbols + np.uint64(step) <= np.uint64(self.symbols(length)))
            yield row, self.key(sums[row] + factors[place] * np.uint64(step), length)

    def shortened(self, letters: np.ndarray):
        """(rows, keys) of all distinct strings that lack one symbol."""
        length = letters.shape[1]
        symbols, factors = self.reduce(letters, length - 1), self.factors(length)
        before = np.zeros(symbols.shape, np.uint64)
        after = np.zeros(symbols.shape, np.uint64)
        np.cumsum((symbols * factors)[:, :-1], 1, out=before[:, 1:])
        after[:, :-1] = np.cumsum((symbols[:, 1:] * factors[:-1])[:, ::-1], 1)[:, ::-1]
        # Within a stretch of equal symbols it makes no difference which one goes.
        new = np.ones(symbols.shape, bool)
        new[:, 1:] = symbols[:, 1:] != symbols[:, :-1]
        row, place = np.nonzero(new)
        return row, self.key(before[row, place] + after[row, place], length - 1)


def _by_length(batch: pa.RecordBatch):
    """(row numbers, letters) of the words of each length, a bounded number of letters at a time."""
    words = batch.column("word").to_pylist()
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, _ROWS // max(int(length), 1))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            letters = np.frombuffer("".join(words[r] for r in part).encode("utf-32-le"), np.uint32)
            yield part, letters.reshape(len(part), length)


def _own_keys(words: int):
    schema = pa.schema([("key", pa.int64()), ("near_id", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def run(batches):
        reducer = _Reducer(words)
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.int64)
            for rows, letters in _by_length(batch):
                keys[rows] = reducer.own(letters)
            columns = [pa.array(keys), batch.column("id"), batch.column("word").cast(pa.string()), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _neighbour_keys(words: int, shortest: int):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("same", pa.bool_())])

    def rows_of(ids, keys, same=False):
        columns = [pa.array(keys), pa.array(ids), pa.array(np.full(len(keys), same))]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        reducer = _Reducer(words)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for rows, letters in _by_length(batch):
                yield rows_of(ids[rows], reducer.own(letters), True)
                for row, keys in reducer.replaced(letters):
                    yield rows_of(ids[rows[row]], keys)
                if letters.shape[1] > shortest:
                    row, keys = reducer.shortened(letters)
                    yield rows_of(ids[rows[row]], keys)

    return run


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows (word, form): the last form, by doubling the steps.

    A form is more frequent than its word, so the steps end. Each round is stored.
    """
    roots = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        longer = store(roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), "onward"), "roots")
        if longer.where("onward IS NOT NULL").isEmpty():
            return roots
        roots = longer.select("word", "root")


@complete
def spelling_variants(vocabulary: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``vocabulary``.

    Two words are near if they differ by one code point that is inserted, deleted or
    replaced; n_near counts a word's near words. Its form is the near word with the largest n,
    the first in code-point order of equals, if that n is at least ``ratio`` (more than 1)
    times the word's own; otherwise form and form_n are NULL. root is the last of the
    word, its form, the form's form and so on.

    Needs columns word and n (how often it occurs) and ignores others, whatever their names. Rows
    with one word are added up. NULL words are left out, NULL counts are 0; the empty word is near to every
    word of one letter. Very long words are taken whole. An empty table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("ratio must be more than 1")
    words = vocabulary.where(F.col("word").isNotNull()).groupBy(F.col("word").cast("string").alias("word"))
    words = words.agg(F.coalesce(F.sum(F.col("n").cast("bigint")), F.lit(0)).alias("n"))
    words = store(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    count, shortest = words.agg(F.count("*"), F.coalesce(F.min(F.char_length("word")), F.lit(0))).first()
    reduced = words.mapInArrow(_own_keys(count), "key long, near_id long, near string, near_n long")
    around = words.select("id", "word").mapInArrow(_neighbour_keys(count, shortest), "key long, id long, same boolean")
    met = around.join(reduced, "key").where("NOT same OR id < near_id").select("id", "near", "near_n")
    links = met.join(words, "id").where(F.levenshtein("word", "near", 1) == 1)
    links = store(links.select("word", "n", "near", "near_n"), "links")
    either = links.select("word", "near", F.col("near_n").alias("m"))
    either = either.union(links.select("near", "word", "n"))
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("near").alias("form")))
    nearest = either.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    out = words.drop("id").join(nearest, "word", "left")
    known = (-F.col("best.less") >= ratio * F.col("n")) & (F.col("best.less") < 0)
    out = out.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(known, F.col("best.form")).alias("form"),
        F.when(known, -F.col("best.less")).alias("form_n"),
    )
    out = store(out, "forms")
    roots = _roots(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def letter_runs(docs: DataFrame, least: int = 7) -> DataFrame:
    """``word, n``: how often runs of letters (A-Z, a-z, U+00C0 to U+00FF) occur, with planted slips.

    A-Z count as a-z. With h the crc32 of ``<doc_id>:<run>``: if 31 divides h, the run
    lacks its letter h % length. Only words of ``least`` letters or more remain. A NULL
    text has none; a NULL doc_id counts as empty text.
    """
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least},}})"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    rows = rows.select("d", F.translate("run", _A_TO_Z.upper(), _A_TO_Z).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    words = rows.select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


@query()
def op11_reduced_alphabet_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of all words of seven letters and more that occur twice."""
    words = letter_runs(table(spark, sf_dir, "documents")).where("n >= 2")
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")

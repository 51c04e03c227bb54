"""Periodic runs of words: boilerplate that a text repeats over and over.

Every text is searched for maximal runs whose words repeat with a period at least three
times. Candidate periods come from internal pattern matching (``pattern_index``), and
each is extended to its maximal run and checked word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .pattern_index import cubic_runs
from .tables import table

_CHUNK = 1 << 18  # words that are indexed together; a longer text is alone
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _runs_of(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text."""
    counts = np.array([len(t) for t in texts])
    stops = np.cumsum(counts)
    firsts = stops - counts
    words = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    # A word of one text is another symbol than the same word of another text.
    symbols = words.indices.to_numpy().astype(np.int64) + np.repeat(np.arange(len(texts)) * len(words.dictionary), counts)
    starts, lengths, periods = cubic_runs(symbols, np.repeat(firsts, counts), np.repeat(stops, counts), least)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for doc, *run in zip(
        np.searchsorted(stops, starts, side="right").tolist(), starts.tolist(), lengths.tolist(), periods.tolist(), strict=True
    ):
        found[doc].append((run[0] - int(firsts[doc]), run[1], run[2]))
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and those of each run's first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def _scan(least: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

    def result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _runs_of(texts, least)
        as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs]
        collapsed = pa.array([_collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string())
        columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(as_rows, pa.list_(_RUN))]
        return pa.RecordBatch.from_arrays([*columns, collapsed], schema=schema)

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                # Bytes split at the six ASCII blanks only, as words are defined here.
                words = (text.as_py() or b"").split()
                if texts and size + len(words) > _CHUNK:
                    yield result(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id.as_py())
                texts.append(words)
                size += len(words)
            if texts:
                yield result(ids, texts)

    return run


def periodic_runs(docs: DataFrame, least: int = 24) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row, in no certain order.

    ``runs`` are all stretches (start, length, period) of words, by start, then period,
    that repeat with their smallest period at least three times, have ``least`` (24 or
    more) words or more, and can't be extended; runs may overlap. ``collapsed`` is the
    text without the words that a run holds after its first period, one space between
    words. Words lie between the blanks space and tab to carriage return and are compared
    byte by byte.

    Needs columns doc_id and text and ignores others, whatever their names. A text that is
    NULL, empty or without words has no runs and collapses to the empty string. Rows
    that share a doc_id or have none are separate rows with results of their own, so
    repeated rows give repeated results. An empty table gives an empty one. A text is
    searched whole however long it is, by one task, with some hundred bytes a word.
    """
    if least < 24:
        raise ValueError("runs have at least 24 words")
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(_scan(least), _SCHEMA)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equals; NULL without runs."""

    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run.length * best.period > best.length * run.period)
        return F.when(more, run).otherwise(best)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) where about each tenth text becomes periodic from some word on.

    With h the crc32 of the doc_id in decimal: if 10 divides h, every word from a on, with
    a = g % n and g = h // 10, is replaced so that a period of 1 + (n - a) // (3 + g % 8)
    words repeats. A NULL doc_id counts as empty text.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_w").cast("bigint"), F.floor(F.col("_h") / 10)
    a = g % n
    rows = rows.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8))))
    place = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")),
    )
    changed = F.array_join(F.transform(place, lambda i: F.get("_w", i.cast("int"))), " ")
    return rows.select("doc_id", F.when(n > 0, changed).otherwise(F.col("text")).alias("text"))


@query()
def op12_internal_pattern_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and digests of them and of what is left."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))).withColumn("best", longest_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

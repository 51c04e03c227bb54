"""Weighted random walks over the bigram table, for many seeds at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws
from ..session import bucketed, materialize
from .transitions import cumulative

# Successors that one slot of a word holds on average.
SLOT_ROWS = 64
# A slot is drawn in about one step of so many at most.
SLOT_SHARE = 1024


def _with_width(df: DataFrame, slot_rows: int, whole: int) -> DataFrame:
    """Length of one slot of a word's range [0, total), in draw units.

    A word has slots for its successors, and more of them the more often it occurs, so
    that the walks at a frequent word with few successors spread as well. ``whole`` is the sum of all totals.
    """
    slots = f"(1 + size div {slot_rows} + total div {whole // SLOT_SHARE + 1})"
    return df.withColumn("width", F.expr(f"(total + {slots} - 1) div {slots}"))


def word_ranges(totals: DataFrame, whole: int, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(word, total, width) of every word that has a successor."""
    words = totals.groupBy(F.col("gram0").alias("word")).agg(F.sum("n").alias("total"), F.count("*").alias("size"))
    return _with_width(words, slot_rows, whole).drop("size")


def walk_index(totals: DataFrame, ranges: DataFrame, whole: int, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Successor ranges keyed by (gram0, slot).

    A word's range is cut into slots of equal length, about ``slot_rows``
    successors each. A draw falls into one slot, so a walk meets some dozen
    candidates and not all successors of its word, and the walks of a frequent
    word fall into many keys. A successor wider than a slot is entered in each
    slot it touches: at most one extra row per slot.
    """
    slots = F.explode(F.expr("sequence(cum_lo div width, (cum_hi - 1) div width)")).alias("slot")
    return _with_width(cumulative(totals), slot_rows, whole).select("gram0", "gram1", "cum_lo", "cum_hi", slots)


def _drawn(walkers: DataFrame, seed: int) -> DataFrame:
    return walkers.withColumn("draw", draws.draw(seed, F.col("walk_id"), F.col("words")))


def _placed(walkers: DataFrame, ranges: DataFrame) -> DataFrame:
    """Where each walker's draw falls in the range of its word; NULL at the end of a walk."""
    at = walkers.hint("shuffle_hash").join(ranges, F.col("gram0") == F.col("word"), "left").drop("word")
    placed = at.withColumn("place", F.col("draw") % F.col("total"))
    return placed.withColumn("slot", F.expr("place div width")).drop("draw", "total", "width")


def _step(walkers: DataFrame, index: DataFrame, seed: int) -> DataFrame:
    """One move of every walker that has somewhere to go, and its next draw.

    The walkers of a bucket are few beside its part of the index: they are hashed and the
    index streams by, which spares sorting it in every step.
    """
    candidates = walkers.hint("shuffle_hash").join(index, ["gram0", "slot"])
    moved = candidates.where((F.col("cum_lo") <= F.col("place")) & (F.col("place") < F.col("cum_hi")))
    return _drawn(
        moved.select(
            "walk_id",
            (F.col("words") + 1).alias("words"),
            F.concat_ws(" ", "phrase", "gram1").alias("phrase"),
            F.col("gram1").alias("gram0"),
        ),
        seed,
    )


def walk(
    totals: DataFrame, seeds: DataFrame, max_words: int, seed: int = 42, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """(walk_id, words, phrase) for every seed, at most ``max_words`` words long.

    ``totals`` is a stored (gram0, gram1, n) table and ``seeds`` is (walk_id, word) with unique ids. Step k of a walk draws a
    number from (seed, walk_id, k) and takes the successor whose range holds
    it. A walk ends early at a word without successor. Ranges and index are stored in
    buckets once; each step moves only the walks still going, to them and then to the range of
    their next word, which so need not be stored with every successor. Its result is written
    to the shared folder. A walk carries its phrase along, so the finished ones stay put.
    """
    whole = totals.agg(F.sum("n")).first()[0] or 0
    ranges = bucketed(word_ranges(totals, whole, slot_rows), ["word"], "ranges")
    index = bucketed(walk_index(totals, ranges, whole, slot_rows), ["gram0", "slot"], "index")
    word = F.col("word")
    first = seeds.select("walk_id", F.lit(1).alias("words"), word.alias("phrase"), word.alias("gram0"))
    steps = [materialize(_placed(_drawn(first, seed), ranges), "step-1")]
    ended = []
    for k in range(2, max_words + 1):
        going = F.col("place").isNotNull()
        ended.append(steps[-1].where(~going))
        moved = _step(steps[-1].where(going), index, seed)
        steps.append(materialize(_placed(moved, ranges) if k < max_words else moved, f"step-{k}"))
    return reduce(DataFrame.unionByName, [df.select("walk_id", "words", "phrase") for df in [*ended, steps[-1]]])

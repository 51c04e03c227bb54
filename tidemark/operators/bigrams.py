"""Bigram lines to bigram counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import BIGRAM_PATTERN, WORD_PATTERN
from ..session import materialize
from .scan import in_order

_BLOCK = "_block"


def split_words() -> tuple[Column, Column]:
    """The first two words of a bigram string; the second may be missing."""
    parts = F.split("bi_gram", " ")
    return F.get(parts, F.lit(0)).alias("gram0"), F.get(parts, F.lit(1)).alias("gram1")


def usable() -> Column:
    """True where both words consist of letters only."""
    return F.col("gram0").rlike(WORD_PATTERN) & F.col("gram1").rlike(WORD_PATTERN)


def _two_words(pair: str) -> tuple[Column, Column]:
    """The words of a string known to hold exactly two."""
    return F.substring_index(pair, " ", 1).alias("gram0"), F.substring_index(pair, " ", -1).alias("gram1")


def clean(ngrams: DataFrame, first_two: bool = False) -> DataFrame:
    """Keep bigrams of two all-letter words, as (gram0, gram1, match_count).

    By default the whole string must be two words. With ``first_two`` only the
    first two words are looked at and any further ones are ignored.
    """
    if first_two:
        return ngrams.select(*split_words(), "match_count").where(usable())
    return ngrams.where(F.col("bi_gram").rlike(BIGRAM_PATTERN)).select(*_two_words("bi_gram"), "match_count")


def counts(cleaned: DataFrame) -> DataFrame:
    """Total per bigram, combined map-side before the one shuffle."""
    return cleaned.groupBy("gram0", "gram1").agg(F.sum("match_count").alias("matchcount"))


def _runs(rows: DataFrame, piece: Sequence[str], along: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Runs of the rows of each piece, as rows of the same kind with their number in ``_run``.

    A row goes on with the one before it if both have one pair, it ``_opens`` what it comes from,
    and the other ``_closes`` it. A run opens its piece if its first row is the piece's first
    one and opens what it comes from itself; closing is the same at the end. Rows without
    these columns are lines, which always do both.
    """
    window = Window.partitionBy(*piece).orderBy(*along)
    lines = "_opens" not in rows.columns
    opens, closes = (F.lit(True),) * 2 if lines else (F.col("_opens"), F.col("_closes"))
    closed = F.lit(True) if lines else F.lag("_closes").over(window)
    # Plain columns only: what a window makes of several would move beside them.
    before = F.lag("_pair").over(window)
    goes_on = opens & F.coalesce(closed & (before == F.col("_pair")), F.lit(False))
    marked = rows.withColumns(
        {"_begins": ~goes_on, "_head": before.isNull(), "_tail": F.lead("_pair").over(window).isNull()}
    )
    run = F.sum(F.col("_begins").cast("bigint")).over(window.rowsBetween(Window.unboundedPreceding, 0))
    # Same partitioning as the window: no further shuffle.
    return (
        marked.withColumn("_run", run)
        .groupBy(*piece, "_run", "_pair")
        .agg(
            *[F.max(F.when(F.col("_begins"), F.col(c))).alias(c) for c in order],
            F.sum("matchcount").alias("matchcount"),
            F.max(F.col("_head") & opens).alias("_opens"),
            F.max(F.col("_tail") & closes).alias("_closes"),
        )
    )


def run_totals(ngrams: DataFrame, order: Sequence[str], block: Column, file: str = "file_no") -> DataFrame:
    """Totals over runs of consecutive lines with the same first two words.

    ``order`` is the line order inside a file and must be unique there;
    ``block`` must not decrease along it and cuts a file into pieces that are
    scanned side by side. A piece first adds up its own runs; only its first
    and last run can go on in a neighbour. These are sorted along the files by a range
    shuffle and put together by its tasks, and what still goes on from task to task
    by file: two rows a task at most. Runs are found over all lines, and only those
    of two all-letter words are returned, with the order of their first line. Of other lines
    nothing is asked but that they end a run: they move without their words, and are stored
    at the edges of a piece only.
    """
    order = list(order)
    # The first two words as one string; never NULL, so NULL can mean "no neighbour".
    pair = F.substring_index("bi_gram", " ", 2)
    pair = F.when(pair.rlike(BIGRAM_PATTERN), pair).otherwise("")
    lines = ngrams.select(
        file,
        *order,
        block.alias(_BLOCK),
        pair.alias("_pair"),
        F.col("match_count").alias("matchcount"),
    )
    going_on = F.col("_opens") | F.col("_closes")
    # Found once each: the runs inside a piece are done, those at its edges go on below.
    in_blocks = _runs(lines, [file, _BLOCK], order, order)
    in_blocks = materialize(in_blocks.where(going_on | (F.col("_pair") != "")), "runs")
    edges = in_order(in_blocks.where(going_on), [file, _BLOCK, "_run"], "edges")
    in_tasks = materialize(_runs(edges.drop("_run"), [file, "_task"], ["_at"], order), "joined")
    whole = _runs(in_tasks.where(going_on).withColumnRenamed("_run", "_nth"), [file], ["_task", "_nth"], order)
    columns = [file, *order, "_pair", "matchcount"]
    found = in_blocks.where(~going_on).select(*columns).unionByName(in_tasks.where(~going_on).select(*columns))
    return found.unionByName(whole.select(*columns)).where(F.col("_pair") != "").select(
        file, *order, *_two_words("_pair"), "matchcount"
    )


def file_slice(ngrams: DataFrame, first: int, last: int, file: str = "file_no") -> DataFrame:
    """The files ``first`` to ``last``; on a folder column this prunes the scan."""
    return ngrams.where(F.col(file).between(first, last))

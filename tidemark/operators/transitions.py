"""Next-word distributions of a bigram table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import prefix_totals


def totals(counts: DataFrame) -> DataFrame:
    """(gram0, gram1, n), merged over shards."""
    return counts.groupBy("gram0", "gram1").agg(F.sum("matchcount").alias("n"))


def successors(counts: DataFrame, word: str) -> DataFrame:
    """(gram1, n, probability) after one word, compared as a literal.

    The filter reaches the scan; the answer has one row per successor.
    """
    rows = counts.where(F.col("gram0") == word)
    whole = rows.agg(F.sum("matchcount")).scalar()
    return totals(rows).select("gram1", "n", (F.col("n") / whole).alias("probability"))


def cumulative(totals: DataFrame) -> DataFrame:
    """Half-open ranges [cum_lo, cum_hi) of every successor, by gram1.

    ``size`` is the word's number of successors; see :mod:`.scan` for words with very many.
    """
    scanned = prefix_totals(totals, ["gram0"], ["gram1"], {"cum_hi": F.col("n"), "place": F.lit(1).cast("bigint")})
    return scanned.select(
        "gram0",
        "gram1",
        "n",
        (F.col("cum_hi") - F.col("n")).alias("cum_lo"),
        "cum_hi",
        F.col("cum_hi_total").alias("total"),
        F.col("place_total").alias("size"),
    )


def probabilities(totals: DataFrame) -> DataFrame:
    """(gram0, gram1, n, total, probability); adaptive execution splits a frequent word's join."""
    per_word = totals.groupBy("gram0").agg(F.sum("n").alias("total"))
    return totals.join(per_word, "gram0").withColumn("probability", F.col("n") / F.col("total"))

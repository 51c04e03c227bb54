"""Words and tags of plain text lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def words(lines: DataFrame, column: str = "value", keep_empty: bool = True) -> DataFrame:
    return lines.select(F.explode(tx.tokens(F.col(column), keep_empty)).alias("word"))


def word_count(lines: DataFrame, column: str = "value", keep_empty: bool = True) -> DataFrame:
    """(word, total). Splitting on one space counts empty words too."""
    return words(lines, column, keep_empty).groupBy("word").agg(F.count("*").alias("total"))


def hashtag_tokens(lines: DataFrame, column: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """One row per ``#`` word, lower-cased, with the columns in ``keep``."""
    tagged = lines.select(*keep, F.explode(tx.tokens(F.lower(column))).alias("tag"))
    return tagged.where(F.startswith("tag", F.lit("#")))


def mention_tokens(lines: DataFrame, column: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """One row per ``@`` word as written."""
    named = lines.select(*keep, F.explode(tx.tokens(F.col(column))).alias("mention"))
    return named.where(F.startswith("mention", F.lit("@")))


def tag_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    return hashtag_tokens(lines, column).groupBy("tag").agg(F.count("*").alias("count"))


def top_tags(counts: DataFrame, n: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("count"), "tag").limit(n)


def tags_sliding(lines: DataFrame, column: str = "value", size: str = "20 seconds", slide: str = "10 seconds") -> DataFrame:
    """Tag counts per sliding event-time window; ``lines`` carries ``ts``."""
    return (
        hashtag_tokens(lines, column, keep=["ts"])
        .groupBy(F.window("ts", size, slide).alias("w"), "tag")
        .agg(F.count("*").alias("count"))
        .select(F.col("w.start").alias("window_start"), "tag", "count")
    )


def track(texts: DataFrame, keywords: Iterable[str], column: str = "text") -> DataFrame:
    """Rows whose text holds one of the keywords."""
    return texts.where(tx.any_keyword(F.col(column), keywords))

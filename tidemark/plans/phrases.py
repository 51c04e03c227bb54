"""From bigram lines to generated phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import bigrams, transitions, walks
from ..session import materialize


def corpus_counts(ngrams: DataFrame, first_two: bool = False) -> DataFrame:
    """(gram0, gram1, matchcount) of all usable bigrams of a corpus."""
    return bigrams.counts(bigrams.clean(ngrams, first_two))


def phrases(counts: DataFrame, seeds: DataFrame, max_words: int, seed: int = 42) -> DataFrame:
    """One phrase per seed, drawn from the next-word distribution of the counts."""
    totals = materialize(transitions.totals(counts), "totals")
    return walks.walk(totals, seeds, max_words, seed)

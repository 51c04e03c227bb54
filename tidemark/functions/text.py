"""String expressions: tokens, trimming, keyword and topic patterns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is made of ASCII letters only.
WORD_PATTERN = "^[A-Za-z]+\\z"
BIGRAM_PATTERN = "^[A-Za-z]+ [A-Za-z]+\\z"


def tokens(text: Column, keep_empty: bool = True) -> Column:
    """Split on single spaces; two spaces in a row give an empty token."""
    words = F.split(text, " ")
    return words if keep_empty else F.filter(words, lambda w: w != "")


def trim_space(text: Column) -> Column:
    """Drop all white space at both ends, tabs and line ends included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_crlf(text: Column, replacement: str = "") -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit(replacement))


def preview(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def any_keyword(text: Column, keywords: Iterable[str]) -> Column:
    """True where the text holds one of the keywords, whatever its case; nothing holds one of none."""
    pattern = "|".join(re.escape(k.lower()) for k in keywords if k)
    return F.lower(text).rlike(pattern) if pattern else F.lit(False)


def topic_pattern(topic_filter: str) -> str:
    """Anchored regular expression of a broker filter.

    ``+`` stands for exactly one level, which is not empty. ``#`` is allowed as the last level and
    stands for the parent and everything below it.
    """
    levels = topic_filter.split("/")
    if "#" in levels[:-1]:
        raise ValueError("'#' may only be the last level")
    rest = levels[-1] == "#"
    named = levels[:-1] if rest else levels
    body = "/".join("[^/]+" if level == "+" else re.escape(level) for level in named)
    if not rest:
        return f"^{body}\\z"
    return f"^{body}(/.*)?\\z" if named else "^.*\\z"


def matches_topic(topic: Column, topic_filter: str) -> Column:
    return topic.rlike(topic_pattern(topic_filter))

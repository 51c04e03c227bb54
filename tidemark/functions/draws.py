"""Reproducible pseudo-random integers from a hash of their coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_prefix(text: Column, digits: int) -> Column:
    """The first hex digits of the MD5 of ``text`` as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def draw(seed: int, walk: Column, step: Column) -> Column:
    """A 52-bit draw for one step of one walk: same seed, same number."""
    return hex_prefix(F.concat_ws("|", F.lit(str(seed)), walk.cast("string"), step.cast("string")), 13)


def in_sample(key: Column, one_in: int) -> Column:
    """True for one key in ``one_in``, chosen by hash so that reruns agree."""
    return hex_prefix(key.cast("string"), 8) % one_in == 0

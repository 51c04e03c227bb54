from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def documents(spark):
    """A documents frame of (doc_id, text) pairs, with columns whose names clash with inner ones."""

    def make(pairs, parts=3):
        rows = [(i, t, "en", "s", len(t or ""), 1, "x") for i, t in pairs]
        schema = "doc_id long, text string, lang string, source string, n_chars long, k int, d string"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.sample("abcdefghij", 3)) + draw.choice(WORDS) for _ in range(n))

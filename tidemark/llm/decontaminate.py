"""Benchmark passages in documents, by pigeonhole edit matching.

An item may differ by ``budget`` edits. Cut into one piece more than that, one piece must
stand in the text unchanged; all pieces are found at once by an Aho-Corasick automaton.
Around each hit the item's edit distance to the best part of the text is computed by
Myers' bit-parallel method, a few operations on whole bit vectors for each character.

Text and items are compared as lower-case words, one blank between them. The benchmark
is handled in blocks of bounded size; every block looks at every text, row by row.
Short items are looked for as they are, on word boundaries, and told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .tables import table

_MATCHES = "array<struct<item_id: long, distance: int, start: int, stop: int>>"
_FOUND = f"struct<short_items: array<long>, matches: {_MATCHES}>"

# Letters and digits stay, as do the bytes of other characters; the rest are blanks.
_PLAIN = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))


def normal(text: str | None) -> str:
    """The words in lower case; each character of the result is a UTF-8 byte."""
    return b" ".join((text or "").lower().encode().translate(_PLAIN).split()).decode("latin-1")


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the part of ``text`` closest to ``pattern``, the first end of equals."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | (1 << i)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        up = mh | (full & ~(xv | ph))
        down = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error: float):
        self.items = [(i, t, int(len(t) * error)) for i, t in items]
        self.machine = ahocorasick.Automaton()
        for n, (_, text, budget) in enumerate(self.items):
            for p in range(budget + 1):
                a, b = p * len(text) // (budget + 1), (p + 1) * len(text) // (budget + 1)
                known = self.machine.get(text[a:b], None)
                if known is None:
                    self.machine.add_word(text[a:b], [(n, b)])
                else:
                    known.append((n, b))
        if len(self.machine):
            self.machine.make_automaton()

    def __call__(self, raw: str | None) -> list[dict]:
        text = normal(raw)
        if not text or not len(self.machine):
            return []
        begins: dict[int, list[int]] = {}
        for end, places in self.machine.iter(text):
            for n, b in places:
                begins.setdefault(n, []).append(end + 1 - b)
        out = []
        for n, starts in begins.items():
            item, pattern, budget = self.items[n]
            found, m = None, len(pattern)
            exact = text.find(pattern)
            if exact >= 0:
                found = (0, exact, exact + m)
            elif budget:
                # Hits whose items would begin close to each other share a look.
                starts.sort()
                i = 0
                while i < len(starts):
                    j = i
                    while j + 1 < len(starts) and starts[j + 1] - starts[j] <= 2 * budget:
                        j += 1
                    low = max(starts[i] - budget, 0)
                    part = text[low : starts[j] + m + budget]
                    distance, end = myers(pattern, part)
                    if distance <= budget and (found is None or distance < found[0]):
                        back, length = myers(pattern[::-1], part[:end][::-1])
                        found = (distance, low + end - length, low + end)
                    i = j + 1
            if found:
                out.append({"item_id": item, "distance": found[0], "start": found[1], "stop": found[2]})
        return sorted(out, key=lambda x: (x["item_id"] is None, x["item_id"] or 0, x["start"]))


class ShortMatcher:
    """Finds the short items of one block in texts, unchanged and as whole words."""

    def __init__(self, items: list[tuple[int, str]]):
        self.machine = ahocorasick.Automaton()
        ids: dict[str, list[int]] = {}
        for i, text in items:
            ids.setdefault(f" {text} ", []).append(i)
        for key, of_key in ids.items():
            self.machine.add_word(key, (key, of_key))
        if ids:
            self.machine.make_automaton()

    def __call__(self, raw: str | None) -> list[int]:
        if not len(self.machine):
            return []
        found = dict(x for _, x in self.machine.iter(f" {normal(raw)} "))
        return sorted((i for ids in found.values() for i in ids), key=lambda i: (i is None, i or 0))


def _looking_for(held, error: float, shortest: int):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), *((c, pa.int32()) for c in ("distance", "start", "stop"))]))

    @F.arrow_udf(_FOUND)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher([x for x in held.value if len(x[1]) >= shortest], error)
        short = ShortMatcher([x for x in held.value if len(x[1]) < shortest])
        for texts in batches:
            texts = texts.to_pylist()
            found = [pa.array(map(short, texts), pa.list_(pa.int64())), pa.array(map(matcher, texts), kind)]
            yield pa.StructArray.from_arrays(found, ["short_items", "matches"])

    return match


def find(docs: DataFrame, benchmark: DataFrame, error: float = 0.05, shortest: int = 20, block: int = 1 << 22) -> DataFrame:
    """The rows of ``docs`` with ``short_items`` and a last column ``matches``: the items each text holds.

    ``benchmark`` has item_id and text. Items whose normal form is below ``shortest`` bytes
    say too little to be matches; ``short_items`` has the ids of those that stand in the text
    unchanged, as whole words. Items without a word are in no text. A match has the best distance, at most
    ``error`` times the item's length, and its place in the normal form of the document.
    A NULL or empty text has no matches; repeated rows and items count each by itself.
    ``block`` bounds the bytes of items that are sent to the executors at a time.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block)
    spark = docs.sparkSession
    columns = []
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        known = [(i, n) for i, t in mine if (n := normal(t))]
        known.sort(key=lambda x: (x[1], x[0] is None, x[0] or 0))
        held = spark.sparkContext.broadcast(known)

        columns.append(_looking_for(held, error, shortest)(F.col("text").cast("string")))
    found = docs.select("*", *[c.alias(f"_found_{b}") for b, c in enumerate(columns)])
    short = [F.col(f"_found_{b}.short_items") for b in range(blocks)]
    matches = [F.col(f"_found_{b}.matches") for b in range(blocks)]
    found = found.withColumn("short_items", F.concat(F.array().cast("array<long>"), *short))
    found = found.withColumn("matches", F.concat(F.array().cast(_MATCHES), *matches))
    return found.drop(*[f"_found_{b}" for b in range(blocks)])


@query()
def op6_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items in every document."""
    rows = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.col("matches.item_id").alias("item_ids"),
        F.col("matches.distance").alias("distances"),
        "short_items",
    )

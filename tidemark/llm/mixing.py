"""Mixing sources to target weights by temperature.

The weights are the sources' shares of tokens to the power of an exponent, normalised.
The exponent is found by bisection: the largest in [0, 1] whose weights reach a target
entropy, or, where that would repeat a source too often, the smallest that keeps to the
limit of repeats. A source's weight times the budget is its quota of tokens.

A quota is realised as whole passes over the source and a part of one more. Each document
falls into a block by a hash; the last pass goes through the blocks in the order of another
hash, a permutation that the seed picks, and ends inside the block that the quota cuts.
So the sums by block decide, and only the cut block's documents are put in order.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import query
from .tables import complete, store, table

_GAPS = " \t\n\x0b\x0c\r"


def exponent(tokens: list[int], entropy: float, repeats: float) -> float:
    """The exponent for sources of these sizes, all above 0.

    ``entropy`` is the target as a share of that of equal weights. ``repeats`` limits
    how often the smallest source is passed when the largest is passed once.
    """
    if len(tokens) < 2:
        return 1.0

    def reached(a: float) -> bool:
        logs = [a * math.log(t) for t in tokens]
        top = max(logs)
        parts = [math.exp(x - top) for x in logs]
        total = math.fsum(parts)
        return -math.fsum(p / total * math.log(p / total) for p in parts) >= entropy * math.log(len(tokens))

    def bisect(good) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if good(middle) else (low, middle)
        return low

    # Passes go as size ** (a - 1), so their ratio is that of the sizes to the power 1 - a.
    ratio = math.log(max(tokens) / min(tokens))
    flat = 1.0 if reached(1.0) else bisect(reached)
    kept = 0.0 if ratio <= math.log(repeats) else 1 - math.log(repeats) / ratio
    return max(flat, kept)


def n_tokens(text: Column) -> Column:
    """The words between separators."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(_GAPS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+", -1))).cast("bigint")


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text", F.lit("block")), F.lit(blocks))


def _turn(seed: int, source: Column, block: Column) -> Column:
    """A block's place in the permutation of the last pass."""
    return F.xxhash64(F.lit(seed), source, block, F.lit("turn"))


def _rank() -> Column:
    return F.xxhash64("doc_id", "text", F.lit("rank"))


@complete
def plan(
    docs: DataFrame,
    entropy: float = 0.95,
    repeats: float = 4.0,
    budget: int | None = None,
    seed: int = 0,
    blocks: int = 4096,
    sources: int = 1_000_000,
) -> DataFrame:
    """One row for each source: tokens, weight, quota, passes and where the last pass ends.

    Without a ``budget`` the least one is taken that passes every source once, so that
    nothing is lost. More than ``sources`` sources are refused: their sizes are weighed in the driver.
    A NULL source is a source of its own; one without tokens is passed once.
    """
    rows = docs.select(
        "source", n_tokens(F.col("text")).alias("n"), _block(blocks).alias("block"), _rank().alias("rank")
    )
    rows = store(rows, "mix_rows")
    by_block = rows.groupBy("source", "block").agg(F.sum("n").alias("n"))
    by_block = store(by_block, "mix_blocks")
    sizes = by_block.groupBy("source").agg(F.sum("n").alias("n")).limit(sources + 1).collect()
    if len(sizes) > sources:
        raise ValueError(f"more than {sources} sources")
    sizes = sorted(((r.source, r.n) for r in sizes), key=lambda x: (x[0] is None, x[0] or ""))
    live = [n for _, n in sizes if n > 0]
    power = exponent(live, entropy, repeats) if live else 1.0
    total = math.fsum((n / max(live)) ** power for n in live)
    weights = [(n / max(live)) ** power / total if n > 0 else 0.0 for _, n in sizes]
    if budget is None:
        budget = math.ceil(max((n / w for (_, n), w in zip(sizes, weights, strict=True) if w > 0), default=0))
    made = []
    for (source, n), weight in zip(sizes, weights, strict=True):
        quota = round(weight * budget) if n else 0
        passes = quota // n if n else 1
        made.append((source, n, weight, quota, passes, quota - passes * n))
    schema = "source string, tokens long, weight double, quota long, passes long, rest long"
    plans = docs.sparkSession.createDataFrame(pa.Table.from_pylist(
        [dict(zip(("source", "tokens", "weight", "quota", "passes", "rest"), r, strict=True)) for r in made],
        pa.schema([("source", pa.string()), ("tokens", pa.int64()), ("weight", pa.float64())] + [(c, pa.int64()) for c in ("quota", "passes", "rest")]),
    ), schema)

    # The last block that begins within the rest, and what is left for it.
    order = Window.partitionBy("source").orderBy("turn")
    cut = by_block.withColumn("turn", _turn(seed, F.col("source"), F.col("block")))
    cut = cut.withColumn("before", F.sum("n").over(order) - F.col("n"))
    cut = cut.join(plans.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
    cut = cut.where("before <= rest and rest > 0").groupBy("source").agg(F.max(F.struct("turn", "block", "before")).alias("x"))
    cut = cut.select(F.col("source").alias("s"), "x.turn", "x.block", "x.before")
    plans = plans.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    # Of that block's documents, the last one that still fits.
    ends = plans.where("turn is not null").select(F.col("source").alias("s"), F.col("block").alias("b"), (F.col("rest") - F.col("before")).alias("room"))
    inside = rows.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    used = F.sum("n").over(Window.partitionBy("source").orderBy("rank"))
    inside = inside.withColumn("used", used).where("used <= room").groupBy("source").agg(F.max("rank").alias("last"))
    inside = inside.select(F.col("source").alias("s"), "last")
    plans = plans.join(inside, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return store(plans.select("source", "tokens", "weight", "quota", "passes", "turn", "last"), "mix_plan")


def copies(docs: DataFrame, plans: DataFrame, seed: int = 0, blocks: int = 4096) -> DataFrame:
    """The rows of ``docs`` with a last column ``copies``: how often the mix has them.

    Rows that repeat have equal hashes and share their fate. No text is shuffled while the plan is small.
    """
    ends = plans.select(F.col("source").alias("_s"), "passes", "turn", "last")
    rows = docs.join(ends, F.col("source").cast("string").eqNullSafe(F.col("_s")), "left")
    turn = _turn(seed, F.col("_s"), _block(blocks))
    more = (turn < F.col("turn")) | ((turn == F.col("turn")) & (_rank() <= F.col("last")))
    more = F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return rows.withColumn("copies", F.col("passes") + more).drop("_s", "passes", "turn", "last")


def mixed(docs: DataFrame, plans: DataFrame, seed: int = 0, blocks: int = 4096) -> DataFrame:
    """``docs`` with each row as often as the mix has it, in the columns of ``docs``."""
    rows = copies(docs, plans, seed, blocks)
    rows = rows.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return rows.select(*docs.columns)


@query()
def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their tokens, their source's weight and their copies in the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plans = plan(docs)
    rows = copies(docs, plans).select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens"), "copies")
    weights = plans.select(F.col("source").alias("_s"), F.round("weight", 9).alias("weight"), "quota")
    return rows.join(weights, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

"""Running totals, ordinals and row numbers that no single task has to walk.

A plain ordered window puts a whole key into one task. Here one range shuffle sorts all
rows by key and order, whatever their number: a key with many rows spans several tasks.
Each task's part of a key is scanned on its own, from the sum of the parts before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

_PLACE_BITS = 33  # of the monotonic id, below the number of the task


def in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted into a stored table, with columns ``_task`` and ``_at`` that follow the order.

    Rows that are equal in ``order`` go by their place in the input, so that many copies
    of one row still fall into several ranges. ``df`` should be read from files, where
    that place is the same in every attempt of a task.
    """
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_rows = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    stored = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)
    return stored.withColumn("_task", F.shiftright("_at", _PLACE_BITS))


def prefix_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Inclusive running totals per key, plus each key's grand total.

    For every entry of ``values`` the result has the running total under its name and
    the key's total as ``<name>_total``. A NULL value adds nothing, NULL keys are keys
    like any other, and rows equal in ``order`` follow each other in a fixed order. The
    part of a key that one task holds begins with a row that carries the sum of the parts before.
    """
    rows = in_order(df, [*keys, *order], "totals").withColumns({f"_v_{n}": F.coalesce(v, F.lit(0)) for n, v in values.items()})
    part = [*keys, "_task"]
    sums = rows.groupBy(*part).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        *part,
        F.lit(-1).cast("bigint").alias("_at"),
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_v_{n}") for n in values],
        *[F.sum(f"_s_{n}").over(of_key).alias(f"{n}_total") for n in values],
    )
    along = Window.partitionBy(*part).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    scanned = rows.unionByName(carried, allowMissingColumns=True).select(
        *df.columns,
        "_at",
        *[F.sum(f"_v_{n}").over(along).alias(n) for n in values],
        *[F.first(f"{n}_total").over(along).alias(f"{n}_total") for n in values],
    )
    return scanned.where(F.col("_at") >= 0).drop("_at")


def with_ordinal(df: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """Number all rows 1, 2, 3 … along ``order`` without a one-task window.

    The tasks of the range shuffle number their rows, and a running total over one
    count per task joins the pieces.
    """
    numbered = in_order(df, order, "ordinals")
    counts = numbered.groupBy("_task").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    # One row per task of the range shuffle.
    return numbered.join(offsets, "_task").withColumn(name, F.col("_offset") + place + 1).select(*df.columns, name)

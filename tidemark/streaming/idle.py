"""Totals of a stream by key, whose state forgets keys that are no longer seen."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_COUNTS = "key string, n bigint, seen timestamp"
_STATE = "total bigint, seen_ms bigint"


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = pa.table(batch.columns, names=["key", "seen"]).group_by("key")
        counted = counted.aggregate([([], "count_all"), ("seen", "max")])
        yield from counted.select(["key", "count_all", "seen_max"]).rename_columns(["key", "n", "seen"]).to_batches()


def totals(keys: DataFrame, idle_ms: int, watermark: str) -> DataFrame:
    """(key, total) of the keys that a batch brings or that leave, of a stream (key, seen).

    A key's rows are added up until ``seen``, its time, lies ``idle_ms`` behind the watermark.
    The key then leaves the state and its total is given as NULL; seen again, it starts from
    0. Rows are counted within Arrow batches first, so that a hot key moves as few rows.
    """

    def add(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            total = None
        else:
            total, seen = state.get if state.exists else (0, 0)
            for part in rows:
                total += int(part["n"].sum())
                seen = max(seen, int(part["seen"].max().timestamp() * 1000))
            state.update((total, seen))
            state.setTimeoutTimestamp(max(seen + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [key[0]], "total": pd.array([total], "Int64")})

    counted = keys.select(F.col("key"), F.col("seen")).mapInArrow(_partial, _COUNTS)
    grouped = counted.withWatermark("seen", watermark).groupBy("key")
    return grouped.applyInPandasWithState(
        add, "key string, total bigint", _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )

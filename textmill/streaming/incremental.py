"""Incremental forms of batch operators: counts in windows, recomputation of changed rows, upserts of micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_exposure(events: DataFrame, time: str, key: str, *, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by window and key with a watermark: the stream's form of counts on a calendar."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.col(key).alias("key")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "key", "n")


def sessions(events: DataFrame, time: str, key: str, *, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), F.col(key).alias("key")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "key", "n")


def changed_only(rows: DataFrame, key: str, hash_: str) -> DataFrame:
    """(key, hash, first) of rows whose input hash is new for their key; the last hash of each key is the state."""
    kind = dict(rows.dtypes)[key]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        first = last is None
        for b in batches:
            new: list[tuple] = []
            for h in b[hash_]:
                if h != last:
                    new.append((k[0], h, first))
                    last, first = h, False
            if new:
                yield pd.DataFrame(new, columns=["key", "hash", "first"])
        if last is not None:
            state.update((last,))

    return rows.select(F.col(key).alias("key"), hash_).groupBy("key").applyInPandasWithState(step, f"key {kind}, hash string, first boolean", "hash string", "append", GroupStateTimeout.NoTimeout)


def upsert_stream(rows: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    """Micro-batches merged one after another; a batch that comes again after a failure has the same number, so the merge can tell."""
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

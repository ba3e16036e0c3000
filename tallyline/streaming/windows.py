"""Window counts on a stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import BooleanType, StructField, StructType

# The state functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def hop_stream(events: DataFrame, key: str, time: str, size: int, slide: int, late: str = "10 minutes") -> DataFrame:
    """Event-time windows ``[start, start + size)`` every ``slide`` seconds.

    Events later than the watermark are dropped by Spark; :func:`late_rows` tells how
    many that were. Counts are combined on
    the map side before the shuffle, so a busy key sends one row per window and
    task.
    """
    span = F.window(F.col(time), f"{size} seconds", f"{slide} seconds")
    counted = events.withWatermark(time, late).groupBy(span.alias("w"), F.col(key))
    return counted.agg(F.count(F.lit(1)).alias("event_count")).select(
        key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count"
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows a query dropped as later than its watermark, over the progress it still holds.

    Rows are counted as the state step sees them: after the map side has combined
    the events of a window.
    """
    steps = (step for progress in query.recentProgress for step in progress["stateOperators"])
    return sum(int(step["numRowsDroppedByWatermark"]) for step in steps)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the events of each Arrow batch that share a key and a second."""
    for batch in batches:
        merged = pa.Table.from_batches([batch]).group_by(["key", "t"]).aggregate([("n", "sum"), ("first_id", "min")])
        named = merged.select(["key", "t", "n_sum", "first_id_min"]).rename_columns(["key", "t", "n", "first_id"])
        yield from named.cast(batch.schema).to_batches()


def keyed_state(spark: SparkSession) -> None:
    """Streams with timers keep their state in RocksDB; the session's coming queries use it."""
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)


def _per_second(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """One row per second, in order."""
    return pd.concat(parts, ignore_index=True).groupby("t", as_index=False).agg({"n": "sum", "first_id": "min"})


class TrailingCounter(StatefulProcessor):
    """The last ``size`` seconds of a key: counts per second and the second of the last emit.

    A timer at the end of what the state can still tell removes it, so a key that does
    not come back costs nothing. A micro-batch's rows are taken in batch by batch and
    merged per second as soon as they are as many as the seconds so far; what is held is
    as large as the seconds, not as the rows, and a row is merged a few times at most.
    """

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "seconds array<long>, counts array<long>, last_emit long, ends long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        parts, loose = [], 0
        for frame in rows:
            parts.append(frame[["t", "n", "first_id"]])
            loose += len(frame)
            if loose >= len(parts[0]):
                parts, loose = [_per_second(parts)], 0
        fresh = _per_second(parts)
        stored = self.state.get()
        if stored is None:
            # The key is new or its state is gone; what is behind the watermark cannot be counted any more.
            fresh = fresh[fresh["t"] * 1000 >= timerValues.getCurrentWatermarkInMs()].reset_index(drop=True)
            if fresh.empty:
                return
        held_t, held_n, last, ends = stored or ([], [], None, None)
        held = pd.Series(list(held_n), index=list(held_t), dtype="int64")

        both = held.add(pd.Series(fresh["n"].to_numpy(), index=fresh["t"].to_numpy()), fill_value=0).astype("int64").sort_index()
        axis = both.index.to_numpy(dtype="int64")
        running = np.concatenate([[0], np.cumsum(both.to_numpy())])

        t = fresh["t"].to_numpy()
        at = np.searchsorted(t, t[0] if last is None else last + self.slide)
        chosen = []
        while at < len(t):
            chosen.append(at)
            last = int(t[at])
            at = np.searchsorted(t, last + self.slide)

        end = int(axis[-1])
        keep = axis >= end - self.size
        # After this second no event on time counts what is held, nor waits for the slide.
        until = end + max(self.size, self.slide)
        if until != ends:
            if ends is not None:
                self.handle.deleteTimer(ends * 1000)
            self.handle.registerTimer(until * 1000)
        self.state.update((axis[keep].tolist(), both.to_numpy()[keep].tolist(), last, until))
        if chosen:
            out = fresh.iloc[chosen]
            seen = out["t"].to_numpy()
            before = running[np.searchsorted(axis, seen)] - running[np.searchsorted(axis, seen - self.size)]
            yield pd.DataFrame(
                {
                    "key": key[0],
                    "window_start": seen - self.size,
                    "window_end": seen,
                    "first_id": out["first_id"].to_numpy(),
                    "event_count": before + held.reindex(seen, fill_value=0).to_numpy() + 1,
                }
            )

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing_stream(
    events: DataFrame, key: str, time: str, ident: str, size: int, slide: int, late: str = "1 hour"
) -> DataFrame:
    """Exact trailing counter ``[t - size, t]`` with throttled emits, as keyed state with timers.

    Each task merges its events per (key, second) before the shuffle. Inside a
    micro-batch the seconds of a key are taken in order; an event older than what the
    key has already seen is counted while it is inside the window and emits nothing.
    A key leaves the state when the watermark, ``late`` behind the newest event, has
    passed all that its state can matter for; events on time never notice.
    """
    keyed_state(events.sparkSession)
    usable = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    seconds = usable.select(
        F.col(key).alias("key"),
        F.unix_seconds(F.col(time)).alias("t"),
        F.lit(1).cast("long").alias("n"),
        F.col(ident).alias("first_id"),
    )
    kind = {f.name: f.dataType.simpleString() for f in seconds.schema.fields}
    shape = f"key {kind['key']}, window_start long, window_end long, first_id {kind['first_id']}, event_count long"
    merged = seconds.mapInArrow(_combined, seconds.schema).groupBy("key")
    return merged.transformWithStateInPandas(TrailingCounter(size, slide), shape, "append", "EventTime")


class LateMarker(StatefulProcessor):
    """Tells the rows behind the watermark that the micro-batch runs under."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            yield frame.assign(late=frame["millis_"].to_numpy() < mark).drop(columns=["spread_", "millis_"])

    def close(self) -> None:
        pass


def marked_late(events: DataFrame, time: str, late: str, spread: int = 64) -> DataFrame:
    """All events, with ``late``: is the event behind the watermark of its micro-batch?

    Nothing is dropped, so events on time and late ones together are the input. The step
    goes by a hash of the whole row, so no key is a hot spot. Rows without a time are late.
    """
    keyed_state(events.sparkSession)
    if {"late", "spread_", "millis_"} & {c.lower() for c in events.columns}:
        raise ValueError("column names kept for the mark: late, spread_, millis_")
    millis = F.coalesce(F.unix_millis(F.col(time)), F.lit(-(2**62)))
    # The time is handed on as a plain column: Spark would drop late rows before the step by one that bears the watermark.
    plain = F.timestamp_micros(F.unix_micros(F.col(time)))
    tagged = events.withWatermark(time, late).select(
        *((plain if c == time else F.col(f"`{c}`")).alias(c) for c in events.columns),
        F.pmod(F.xxhash64(*events.columns), F.lit(spread)).alias("spread_"),
        millis.alias("millis_"),
    )
    shape = StructType([*events.schema.fields, StructField("late", BooleanType())])
    return tagged.groupBy("spread_").transformWithStateInPandas(LateMarker(), shape, "append", "EventTime")


def once_within(events: DataFrame, keys: Sequence[str], time: str, within: str) -> DataFrame:
    """The first event of each key, for copies that come up to ``within`` apart in event time.

    Copies are told in the stream itself, across micro-batches and restarts; a key is
    forgotten when the watermark has passed it.
    """
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))

"""Trailing window ``[t - size, t]`` per key, anchored at arrivals, and its
throttled emits: the first event of a key emits, then the first event at least
``slide`` seconds after the last emit.

All steps split a key by time chunks, so that a key with a third of all rows is
worked on by many tasks. At most one emit falls in a second and it is always the
second's first event, so events are reduced to one row per (key, second) on the
map side before anything else.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialise

# The group functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_SECONDS = 86400


def per_second(df: DataFrame, key: str, time: str, ident: str) -> DataFrame:
    """Events per key and second, and the lowest id among them."""
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    return (
        df.where(F.col(time).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"), second.alias("t"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id"))
    )


def trailing_counts(seconds: DataFrame, size: int, chunk: int = CHUNK_SECONDS) -> DataFrame:
    """For every (key, second): events in ``[t - size, t]`` when its first event comes.

    A sweep: each second adds its events at ``t`` and takes them away at
    ``t + size + 1``, and the count is the running sum, which costs the same for
    any window size. A second is also given to the next chunk when it is still
    inside the window there.
    """
    chunk = max(int(chunk), int(size) + 1)
    home = F.floor(F.col("t") / chunk)
    reach = F.floor((F.col("t") + size) / chunk)
    spread = seconds.withColumn("home", home).withColumn("chunk", F.explode(F.sequence(F.col("home"), reach)))
    steps = F.array(
        F.struct(F.col("t").alias("at"), F.col("n").alias("change")),
        F.struct((F.col("t") + size + 1).alias("at"), (-F.col("n")).alias("change")),
    )
    swept = spread.select("key", "chunk", "home", "t", "n", "first_id", F.inline(steps))
    running = Window.partitionBy("key", "chunk").orderBy("at")
    counted = swept.withColumn("inside", F.sum("change").over(running))
    own = (F.col("at") == F.col("t")) & (F.col("home") == F.col("chunk"))
    return counted.where(own).select(
        "key", "chunk", "t", "n", "first_id", (F.col("inside") - F.col("n") + 1).alias("event_count")
    )


class _Sorted:
    """Rows of whole (key, chunk) groups, sorted by key, chunk and second.

    The groups are laid end to end on one axis, ``chunk + slide`` apart, so that
    one binary search serves all of them.
    """

    def __init__(self, rows: pd.DataFrame, chunk: int, slide: int) -> None:
        key = pd.factorize(rows["key"], use_na_sentinel=False)[0]
        number = rows["chunk"].to_numpy()
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
        self.head = np.flatnonzero(fresh)
        self.group = np.cumsum(fresh) - 1
        self.since = rows["t"].to_numpy() - number * chunk
        self.fresh = fresh
        self.base = self.group * (chunk + slide)
        self.axis = self.base + self.since
        self.stop = np.append(self.head[1:], len(rows))
        step = np.searchsorted(self.axis, self.axis + slide)
        self.ends = step >= self.stop[self.group]
        self.step = np.where(self.ends, np.arange(len(rows)), step)


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Re-cut sorted batches at group borders; at most one open group is held back."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if rows.empty:
            continue
        last = rows.iloc[-1]
        open_group = ((rows["key"] == last["key"]) & (rows["chunk"] == last["chunk"])).to_numpy()
        cut = len(rows) - int(open_group.sum())
        if cut:
            yield rows.iloc[:cut].reset_index(drop=True)
        held = rows.iloc[cut:]
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def _entry_table(rows: pd.DataFrame, chunk: int, slide: int) -> pd.DataFrame:
    """Possible first emits of each chunk, and the last emit each of them leads to.

    What earlier chunks can change is only the earliest second at which the chunk
    may emit, and that lies in its first ``slide`` seconds.
    """
    at = _Sorted(rows, chunk, slide)
    last = at.step
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    choice = at.fresh.copy()
    choice[1:] |= at.since[:-1] < slide - 1
    # Neighbours that lead to the same end are one entry, under the later of them.
    kept = np.flatnonzero(choice)
    ahead = np.append(kept[1:], kept[-1])
    merged = (at.group[kept] == at.group[ahead]) & (last[kept] == last[ahead])
    merged[-1] = False
    kept = kept[~merged]
    t = rows["t"].to_numpy()
    return pd.DataFrame(
        {
            "key": rows["key"].to_numpy()[kept],
            "chunk": rows["chunk"].to_numpy()[kept],
            "first": t[kept],
            "last": t[last[kept]],
        }
    )


def _emitting_rows(rows: pd.DataFrame, chunk: int, slide: int) -> pd.DataFrame:
    """Rows that emit. The first row of a chunk lies a second before it and only
    tells the earliest second at which the chunk may emit."""
    at = _Sorted(rows, chunk, slide)
    wait = rows["earliest"].to_numpy()[at.head] - rows["chunk"].to_numpy()[at.head] * chunk
    row = np.searchsorted(at.axis, at.base[at.head] + wait)
    row = row[row < at.stop]
    chosen = [row]
    while len(row):
        row = at.step[row[~at.ends[row]]]
        chosen.append(row)
    picked = np.sort(np.concatenate(chosen))
    return rows.iloc[picked][["key", "t", "first_id", "event_count"]]


def trailing_emits(seconds: DataFrame, size: int, slide: int, chunk: int = CHUNK_SECONDS) -> DataFrame:
    """The emitted windows of every key: exact, for keys of any size.

    1. Each chunk alone works out where it would stop for each way to enter it.
    2. Per key, the chunks are walked in order: one lookup per chunk.
    3. Each chunk, led by a row with its true entry, lists its emits.

    Steps 1 and 3 read sorted partitions batch by batch and hold one chunk (at
    most ``chunk`` rows) beyond the batch; step 2 sees at most ``slide + 1`` rows
    per chunk of a key, whatever the number of events, and mostly a handful.
    """
    if slide < 1:
        raise ValueError("slide must be at least one second")
    chunk = max(int(chunk), int(size) + 1, int(slide))
    counted = materialise(trailing_counts(seconds, size, chunk).select("key", "chunk", "t", "first_id", "event_count"))

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches):
            yield _entry_table(rows, chunk, slide)

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["chunk", "first"])
        numbers, heads = np.unique(group["chunk"].to_numpy(), return_index=True)
        first, last = group["first"].to_numpy(), group["last"].to_numpy()
        tails = np.append(heads[1:], len(group))
        earliest, allowed = None, []
        for number, head, tail in zip(numbers, heads, tails):
            start = int(number) * chunk
            entry = start if earliest is None else max(start, earliest)
            allowed.append(entry)
            row = head + int(np.searchsorted(first[head:tail], entry))
            if row < tail:
                earliest = int(last[row]) + slide
        return pd.DataFrame({"key": group["key"].iloc[0], "chunk": numbers, "earliest": allowed})

    def emits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches):
            yield _emitting_rows(rows, chunk, slide)

    def by_chunk(df: DataFrame) -> DataFrame:
        return df.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "t")

    kind = {f.name: f.dataType.simpleString() for f in counted.schema.fields}
    entries = (
        by_chunk(counted.select("key", "chunk", "t"))
        .mapInPandas(tables, f"key {kind['key']}, chunk long, first long, last long")
        .groupBy("key")
        .applyInPandas(walk, f"key {kind['key']}, chunk long, earliest long")
    )
    # The entry comes in as a leading row of its chunk: one shuffle, and no join.
    leads = entries.select(
        "key",
        "chunk",
        (F.col("chunk") * chunk - 1).alias("t"),
        F.lit(0).cast(kind["first_id"]).alias("first_id"),
        F.lit(0).cast("long").alias("event_count"),
        "earliest",
    )
    led = counted.withColumn("earliest", F.lit(0).cast("long")).unionByName(leads)
    emitted = by_chunk(led).mapInPandas(
        emits, f"key {kind['key']}, t long, first_id {kind['first_id']}, event_count long"
    )
    return emitted.select(
        "key",
        (F.col("t") - size).alias("window_start"),
        F.col("t").alias("window_end"),
        "first_id",
        "event_count",
    )

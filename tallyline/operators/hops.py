"""Sliding and tumbling event-time windows, batch form."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hop_counts(df: DataFrame, key: str, time: str, size: int, slide: int) -> DataFrame:
    """Rows per key and window ``[start, start + size)``, windows every ``slide``.

    Rows are first counted per pane (the largest step that divides size and
    slide), and only pane counts are spread over the windows that cover them. A
    row is so touched once, not ``size / slide`` times as by a plain sliding
    ``window()``, and the shuffle carries panes.
    """
    pane = math.gcd(size, slide)
    moment = F.unix_seconds(F.col(time).cast("timestamp"))
    panes = (
        df.where(F.col(time).isNotNull())
        .groupBy(F.col(key), (F.floor(moment / pane) * pane).alias("pane"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    newest = F.floor(F.col("pane") / slide) * slide
    starts = F.sequence(newest, F.col("pane") + (pane - size), F.lit(-slide).cast("long"))
    # A window that covers the pane starts at most size - pane before it; with
    # slide > size the newest start may already be too old.
    covering = F.when(newest >= F.col("pane") + (pane - size), starts)
    spread = panes.select(key, F.explode(covering).alias("start"), "n")
    return (
        spread.groupBy(key, "start")
        .agg(F.sum("n").alias("event_count"))
        .select(
            key,
            F.timestamp_seconds("start").alias("window_start"),
            F.timestamp_seconds(F.col("start") + size).alias("window_end"),
            "event_count",
        )
    )


def tumbling_counts(df: DataFrame, key: str, time: str, size: int) -> DataFrame:
    """Windows that do not overlap."""
    return hop_counts(df, key, time, size, size)

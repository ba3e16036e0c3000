"""Choosing rows by key: dedupe, most frequent value, top k, rank, lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialise


def usable_key(df: DataFrame, key: str) -> DataFrame:
    """Upper-cased, trimmed key; rows with a blank key go."""
    keyed = df.withColumn(key, F.upper(F.trim(F.col(key).cast("string"))))
    return keyed.where(F.length(F.col(key)) > 0)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One whole row per key: the first by ``order``, then by the other columns.

    An aggregate, not a window: copies are dropped on the map side, so a key that
    holds a large part of the table sends one row per task through the shuffle.
    """
    rest = list(order) + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("best"))
    return best.select(*(F.col(c) if c in keys else F.col(f"best.{c}") for c in df.columns))


def most_frequent(
    df: DataFrame, key: str, value: str, count_name: str | None = None, weight: str | None = None
) -> DataFrame:
    """The value seen most often with each key; the smaller value wins a tie.

    ``weight`` names a column of counts, for input that is grouped already.
    """
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    pairs = df.where(F.col(key).isNotNull()).groupBy(key, value).agg(times.alias("n"))
    best = pairs.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("less"), F.col(value))).alias("best"))
    count = [] if count_name is None else [(-F.col("best.less")).alias(count_name)]
    return best.select(key, F.col(f"best.{value}").alias(value), *count)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of a total order (each task keeps k rows, then they merge)."""
    return df.orderBy(*order).limit(int(k))


def rank_in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1-based place of every row in a total order, without a one-task window.

    The rows are range-sorted by Spark and kept (reliable checkpoint, so that the
    places cannot change between the two reads); the place is the number of rows
    in earlier partitions plus the place inside the partition. Only one row per
    partition goes through the running total, and the totals come back as one
    array, so the sorted rows are not shuffled again.
    """
    spot = F.monotonically_increasing_id()
    placed = materialise(df.orderBy(*order).withColumn("spot", spot))
    part = F.shiftright(F.col("spot"), 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    # Empty partitions get an entry too, so that a partition's number is its index.
    parts = df.sparkSession.range(placed._jdf.rdd().getNumPartitions()).select(F.col("id").alias("part"))
    every = parts.join(sizes, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = every.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    listed = starts.agg(F.sort_array(F.collect_list(F.struct("part", "start")))["start"].alias("starts"))
    within = F.col("spot").bitwiseAND((1 << 33) - 1)
    start = F.get(listed.scalar(), part.cast("int"))
    return placed.select(*df.columns, (start + within + 1).alias(name))


def look_up(df: DataFrame, dimension: DataFrame, key: str, label: str, default: str) -> DataFrame:
    """Left lookup with a default label. Spark broadcasts the dimension when its
    measured size is below the session's threshold and sort-merges otherwise."""
    return df.join(dimension.select(key, label), key, "left").withColumn(
        label, F.coalesce(F.col(label), F.lit(default))
    )


def rows_with_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Existence test: rows whose key occurs in ``other``."""
    return df.join(other.select(key), key, "left_semi")

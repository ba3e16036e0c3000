"""Counts: per key, per time grain, with conditions, with rolled-up levels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import ALL


@dataclass(frozen=True)
class Grain:
    """One way to group: a cheap code per row, and its text form per group."""

    name: str
    code: Column
    label: Callable[[Column], Column] = lambda code: code.cast("string")


def time_grains(moment: Column, year: Column | None = None) -> list[Grain]:
    """Year, month, weekday and hour of a time; ``year`` may come from elsewhere."""
    sunday = F.lit("2024-01-07").cast("date")
    return [
        Grain("year", F.year(moment) if year is None else year),
        Grain(
            "month",
            F.year(moment) * 12 + F.month(moment) - 1,
            lambda m: F.format_string("%04d-%02d", F.floor(m / 12), F.pmod(m, F.lit(12)) + 1),
        ),
        Grain("day_of_week", F.dayofweek(moment), lambda d: F.date_format(F.date_add(sunday, d - 1), "EEEE")),
        Grain("hour", F.hour(moment), lambda h: F.format_string("%02d", h)),
    ]


def grain_counts(
    df: DataFrame,
    grains: Sequence[Grain],
    type_name: str = "trend_type",
    key_name: str = "trend_key",
    count_name: str = "crime_count",
) -> DataFrame:
    """Rows per key for every grain, from one scan and one shuffle.

    Rows are grouped by integer codes, so the map side keeps one small counter
    per code; texts are made only for the few groups that are left. A row whose
    code is NULL is not counted in that grain.
    """
    codes = [f"code_{i}" for i in range(len(grains))]
    coded = df.select(*(g.code.alias(c) for g, c in zip(grains, codes)))
    counted = coded.groupingSets([[F.col(c)] for c in codes], *codes).agg(
        F.count(F.lit(1)).alias(count_name), F.grouping_id().alias("absent")
    )
    every = (1 << len(grains)) - 1
    bit = {c: every ^ (1 << (len(grains) - 1 - i)) for i, c in enumerate(codes)}

    kind = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for grain, code in zip(grains, codes):
        chosen = F.col("absent") == bit[code]
        kind = F.when(chosen, F.lit(grain.name)).otherwise(kind)
        key = F.when(chosen, grain.label(F.col(code))).otherwise(key)
    # On the codes, not on the texts: Spark pushes this below the aggregate.
    coded_rows = counted.where(reduce(or_, (F.col(c).isNotNull() for c in codes)))
    return coded_rows.select(kind.alias(type_name), key.alias(key_name), count_name)


def key_counts(df: DataFrame, key: Column, key_name: str, count_name: str) -> DataFrame:
    """Rows per non-blank key."""
    keyed = df.select(key.cast("string").alias(key_name)).where(F.length(F.trim(F.col(key_name))) > 0)
    return keyed.groupBy(key_name).agg(F.count(F.lit(1)).alias(count_name))


def flag_counts(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], total: str) -> DataFrame:
    """Per group: rows for which each flag is true, and all rows. NULL is not true."""
    return df.groupBy(*keys).agg(
        *(F.count_if(flag).alias(name) for name, flag in flags.items()), F.count(F.lit(1)).alias(total)
    )


def roll_up(counts: DataFrame, keys: Sequence[str], kept: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Sum finished counts over some of their keys, which then read ``ALL``.

    Works on the aggregated rows, so the input is not read a second time.
    """
    summed = counts.groupBy(*kept).agg(*(F.sum(m).alias(m) for m in metrics))
    return summed.select(*((F.col(k) if k in kept else F.lit(ALL).alias(k)) for k in keys), *metrics)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0.0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def share_of_total(df: DataFrame, value: str, share: str) -> DataFrame:
    """Each row's part of the whole; the total is a scalar subquery, not a collect."""
    total = df.agg(F.coalesce(F.sum(value), F.lit(0)).alias("total")).scalar()
    return df.withColumn(share, guarded_ratio(F.col(value), total))


def positive_total(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row of sums, or none when the first sum is not positive."""
    summed = df.agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in metrics))
    return summed.where(F.col(metrics[0]) > 0)

"""How many cases have an outcome: one join feeds the detail and the totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.counting import guarded_ratio
from tallyline.operators.keys import top_k

TOTAL, HITS, RATE = "total_crimes", "total_arrests", "arrest_rate"


def outcome_tally(cases: DataFrame, outcomes: DataFrame, case: str, groups: Sequence[str], kind: str) -> DataFrame:
    """Counts of cases per (groups, kind of outcome), with a marker per row.

    ``cases`` has one row per case. Outcomes are reduced to one row per (case,
    kind) and one row per case before the join, in one aggregate. ``whole`` is 0
    for a count of one kind, 1 for cases with any outcome, NULL for cases with
    none, so that all rates come from this small table.
    """
    seen = outcomes.groupingSets([[F.col(case), F.col(kind)], [F.col(case)]], case, kind).agg(
        F.grouping(kind).alias("whole")
    )
    return cases.join(seen, case, "left").groupBy(*groups, kind, "whole").agg(F.count(F.lit(1)).alias("n"))


def _cases() -> Column:
    return F.sum(F.when(F.coalesce(F.col("whole"), F.lit(1)) == 1, F.col("n")).otherwise(0))


def _cases_with_outcome() -> Column:
    return F.sum(F.when(F.col("whole") == 1, F.col("n")).otherwise(0))


def _with_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, TOTAL, HITS, guarded_ratio(F.col(HITS), F.col(TOTAL)).alias(RATE))


def rate_detail(tally: DataFrame, groups: Sequence[str], kind: str) -> DataFrame:
    """Rate per (groups, kind), for kinds that occur; the base ignores the kind."""
    whole_group = _cases().over(Window.partitionBy(*groups))
    rows = tally.withColumn(TOTAL, whole_group).where(F.col("whole") == 0)
    return _with_rate(rows.withColumnRenamed("n", HITS), [*groups, kind])


def rate_of(tally: DataFrame, group: str) -> DataFrame:
    """Rate per value of one group, outcomes of any kind, zero included."""
    summed = tally.groupBy(group).agg(_cases().alias(TOTAL), _cases_with_outcome().alias(HITS))
    return _with_rate(summed, [group])


def best_rates(rates: DataFrame, group: str, k: int) -> DataFrame:
    """The k highest rates; more cases, then the smaller name, win a tie."""
    return top_k(rates, k, F.desc(RATE), F.desc(TOTAL), F.asc(group))

"""Correlation that is always a finite number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation of the rows that have both values.

    No rows, one row, or a constant column give 0.0.
    """
    both = x.isNotNull() & y.isNotNull()
    left, right = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    value = F.try_divide(F.covar_pop(left, right), spread)
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def correlate(df: DataFrame, x: str, y: str) -> Column:
    """Scalar subquery with the correlation of two columns of a table."""
    return df.agg(pearson(F.col(x), F.col(y)).alias("r")).scalar()


def correlation_rows(metrics: DataFrame, name: str, key: str, x: str, y: str) -> DataFrame:
    """Long form: one row per key with both values and the common correlation."""
    return metrics.select(
        F.lit(name).alias("correlation_name"),
        F.col(key).alias("grouping_key"),
        F.lit(x).alias("x_metric"),
        F.lit(y).alias("y_metric"),
        F.col(x).cast("double").alias("x_value"),
        F.col(y).cast("double").alias("y_value"),
        correlate(metrics, x, y).alias("correlation_value"),
    )

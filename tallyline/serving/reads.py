"""Serving queries over published runs, live counts and alerts.

``rows`` arguments are result tables of all runs; :func:`of_latest_run` narrows
them to the newest completed one, which prunes to one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import ALL, UNMATCHED
from tallyline.operators.counting import guarded_ratio
from tallyline.operators.keys import top_k
from tallyline.plans.incidents import METRICS, with_proportion
from tallyline.plans.runs import COMPLETED


def latest_run(states: DataFrame) -> DataFrame:
    """The completed run that finished last: one row, or none."""
    done = states.where(F.col("status") == COMPLETED)
    return top_k(done, 1, F.desc("finished_at"), F.desc("run_id")).select("run_id")


def of_latest_run(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Rows of the newest completed run; its id is a scalar subquery."""
    return rows.where(F.col("run_id") == latest_run(states).scalar()).drop("run_id")


def recent_runs(states: DataFrame, n: int = 10) -> DataFrame:
    """The runs begun last."""
    columns = ["run_id", "job_name", "status", "started_at", "finished_at", "message"]
    return top_k(states, n, F.desc("started_at"), F.asc("run_id")).select(*columns)


def live_alerts(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The newest alerts."""
    newest = top_k(alerts, n, F.desc("alert_timestamp"), F.desc("window_end"), F.asc("alert_id"))
    return newest.select(
        "alert_id", "district", "alert_timestamp", "event_count", "threshold_value", "severity", "message"
    )


def live_counts(counts: DataFrame, n: int = 100) -> DataFrame:
    """The newest window counts.

    ``counts`` may be the newest days' rows only (``BatchTable.newest``): the order
    begins with the end of the window, which names the day.
    """
    newest = top_k(counts, n, F.desc("window_end"), F.asc("district"), F.asc("window_start"))
    return newest.select("district", "window_start", "window_end", "event_count", "updated_at")


def _rolled_up(*levels: str) -> Column:
    both = F.col(levels[0]) == ALL
    for level in levels[1:]:
        both = both & (F.col(level) == ALL)
    return both


def top_rates(rates: DataFrame, n: int = 10) -> DataFrame:
    """Types with the best rate, from the rolled-up rows."""
    rolled = rates.where(_rolled_up("district", "race"))
    best = top_k(rolled, n, F.desc_nulls_last("arrest_rate"), F.desc("total_crimes"), F.asc("primary_type"))
    return best.select("primary_type", "total_crimes", "total_arrests", "arrest_rate")


def rate_details(rates: DataFrame, n: int = 500) -> DataFrame:
    """Detail rows in key order, a page of n."""
    return top_k(rates.where(~_rolled_up("district", "race")), n, F.asc("primary_type"), F.asc("district"), F.asc("race"))


def ranked_areas(density: DataFrame) -> DataFrame:
    """Areas in rank order, without the unmatched row."""
    return density.where(F.col("district") != UNMATCHED).orderBy(
        F.asc_nulls_last("density_rank"), F.desc("offender_count"), F.asc("district")
    )


def unmatched_row(density: DataFrame) -> DataFrame:
    """The unmatched row alone."""
    return density.where(F.col("district") == UNMATCHED)


def top_groups(stats: DataFrame, n: int = 20) -> DataFrame:
    """Rolled-up communities with most incidents."""
    rolled = stats.where(_rolled_up("month", "district")).drop("month", "district")
    return top_k(rolled, n, F.desc_nulls_last("total_incidents"), F.asc("community_area"))


def by_month(stats: DataFrame, *more: str) -> DataFrame:
    """Detail rows summed per month (and more keys), proportion recomputed."""
    summed = (
        stats.where(F.col("month") != ALL).groupBy("month", *more).agg(*(F.sum(m).alias(m) for m in METRICS))
    )
    return with_proportion(summed).orderBy("month", *more)


def headline(stats: DataFrame) -> DataFrame:
    """First and last month, all incidents and the overall gunshot share: one row."""
    totals = stats.where(F.col("month") != ALL).agg(
        F.min("month").alias("earliest_month"),
        F.max("month").alias("latest_month"),
        F.coalesce(F.sum("total_incidents"), F.lit(0)).alias("victimizations"),
        F.coalesce(F.sum("gunshot_incidents"), F.lit(0)).alias("gunshots"),
    )
    share = guarded_ratio(F.col("gunshots"), F.col("victimizations"))
    return totals.withColumn("gunshot_proportion", share).drop("gunshots")


def group_list(stats: DataFrame, column: str = "district") -> DataFrame:
    """The values of a key column, without the rolled-up one."""
    return stats.select(column).where(F.col(column) != ALL).distinct().orderBy(column)


def unpivot_metrics(monthly: DataFrame) -> DataFrame:
    """Metric columns as (month, metric, count) rows."""
    return monthly.unpivot(["month"], METRICS, "metric", "count")


def ordered_trends(trends: DataFrame) -> DataFrame:
    """Trend rows in chart order."""
    return trends.orderBy("trend_type", "trend_key")


def ordered_hotspots(hotspots: DataFrame) -> DataFrame:
    """Hotspots by number."""
    return hotspots.orderBy("cluster_id")


def map_points(hotspots: DataFrame) -> DataFrame:
    """Hotspots under the names a map layer expects."""
    return hotspots.select(
        F.col("centroid_latitude").alias("lat"), F.col("centroid_longitude").alias("lon"), "crime_count"
    )


def correlation_page(correlations: DataFrame, n: int = 100) -> DataFrame:
    """Correlation rows, a page of n."""
    return top_k(correlations, n, F.asc("correlation_name"), F.asc("grouping_key"))


def trend_check(trends: DataFrame) -> DataFrame:
    """Rows and summed counts per trend type."""
    return trends.groupBy("trend_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("crime_count").alias("total_count"))

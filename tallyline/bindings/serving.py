"""Serving queries, each on a table that was staged and published first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.batch import CELLS, CORRELATIONS, DENSITY, RATE_ROWS, STATS_DETAIL, STATS_TOP, rounded, trends_sql
from tallyline.bindings.registry import query
from tallyline.bindings.runs import ORDER_RUNS, order_ledger, published
from tallyline.bindings.tables import stamp
from tallyline.plans.runs import ledger_state
from tallyline.serving import reads


@query(
    "serve_latest_run",
    f"SELECT run_id FROM ({ORDER_RUNS}) WHERE status = 'completed' ORDER BY finished_at DESC, run_id DESC LIMIT 1",
)
def serve_latest_run(spark: SparkSession, folder: str) -> DataFrame:
    return reads.latest_run(ledger_state(order_ledger(spark, folder)))


@query(
    "serve_recent_runs",
    f"""SELECT run_id, job_name, status, started_at, finished_at, message FROM ({ORDER_RUNS})
        ORDER BY started_at DESC, run_id LIMIT 10""",
)
def serve_recent_runs(spark: SparkSession, folder: str) -> DataFrame:
    recent = reads.recent_runs(ledger_state(order_ledger(spark, folder)))
    return recent.withColumns({c: stamp(c) for c in ("started_at", "finished_at")})


@query(
    "serve_top_rates",
    f"""SELECT primary_type, total_crimes, total_arrests, arrest_rate FROM ({RATE_ROWS})
        WHERE district = 'ALL' AND race = 'ALL' ORDER BY arrest_rate DESC NULLS LAST, total_crimes DESC, primary_type LIMIT 10""",
)
def serve_top_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.top_rates(published(spark, folder, "arrest_rates")), "arrest_rate")


@query(
    "serve_detail",
    f"""SELECT * FROM ({RATE_ROWS}) WHERE NOT (district = 'ALL' AND race = 'ALL')
        ORDER BY primary_type, district, race LIMIT 500""",
)
def serve_detail(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.rate_details(published(spark, folder, "arrest_rates")), "arrest_rate")


@query("serve_density", f"WITH {DENSITY} SELECT * FROM density WHERE district <> 'UNMATCHED'")
def serve_density(spark: SparkSession, folder: str) -> DataFrame:
    return reads.ranked_areas(published(spark, folder, "sex_offender_density"))


@query("serve_unmatched", f"WITH {DENSITY} SELECT * FROM density WHERE district = 'UNMATCHED'")
def serve_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return reads.unmatched_row(published(spark, folder, "sex_offender_density"))


@query(
    "serve_top_groups",
    f"SELECT * EXCLUDE (month, district) FROM ({STATS_TOP})",
)
def serve_top_groups(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.top_groups(published(spark, folder, "violence_stats")), "gunshot_proportion")


def _summed(keys: str) -> str:
    return f"""
    SELECT {keys}, CAST(sum(total_homicides) AS BIGINT) AS total_homicides,
           CAST(sum(total_nonfatal_shootings) AS BIGINT) AS total_nonfatal_shootings,
           CAST(sum(gunshot_incidents) AS BIGINT) AS gunshot_incidents, CAST(sum(total_incidents) AS BIGINT) AS total_incidents,
           round(sum(gunshot_incidents) / sum(total_incidents), 6) AS gunshot_proportion
    FROM ({STATS_DETAIL}) GROUP BY {keys}
    """


@query("serve_monthly", _summed("month"))
def serve_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.by_month(published(spark, folder, "violence_stats")), "gunshot_proportion")


@query("serve_month_group", _summed("month, district"))
def serve_month_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.by_month(published(spark, folder, "violence_stats"), "district"), "gunshot_proportion")


@query(
    "serve_headline",
    f"""SELECT min(month) AS earliest_month, max(month) AS latest_month, CAST(sum(total_incidents) AS BIGINT) AS victimizations,
               round(sum(gunshot_incidents) / sum(total_incidents), 6) AS gunshot_proportion
        FROM ({STATS_DETAIL})""",
)
def serve_headline(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reads.headline(published(spark, folder, "violence_stats")), "gunshot_proportion")


@query("serve_group_list", f"SELECT DISTINCT district FROM ({STATS_DETAIL})")
def serve_group_list(spark: SparkSession, folder: str) -> DataFrame:
    return reads.group_list(published(spark, folder, "violence_stats"))


@query(
    "serve_unpivot",
    f"""UNPIVOT (SELECT month, total_homicides, total_nonfatal_shootings, gunshot_incidents, total_incidents
                 FROM ({_summed("month")}))
        ON total_homicides, total_nonfatal_shootings, gunshot_incidents, total_incidents INTO NAME metric VALUE count""",
)
def serve_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return reads.unpivot_metrics(reads.by_month(published(spark, folder, "violence_stats")))


@query("serve_latest_rows", trends_sql("orders", "o_orderdate"))
def serve_latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    return reads.ordered_trends(published(spark, folder, "crime_trends"))


@query("serve_correlations", f"SELECT * FROM ({CORRELATIONS}) ORDER BY correlation_name, grouping_key LIMIT 100")
def serve_correlations(spark: SparkSession, folder: str) -> DataFrame:
    page = reads.correlation_page(published(spark, folder, "correlations"))
    return rounded(page, "x_value", "y_value", "correlation_value")


HOTSPOTS = CELLS.replace("AS cy", "AS cy, count(*) AS crime_count")


@query(
    "serve_hotspots",
    f"SELECT cluster_id, cx AS centroid_latitude, cy AS centroid_longitude, crime_count FROM ({HOTSPOTS}) ORDER BY cluster_id",
)
def serve_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    return reads.ordered_hotspots(published(spark, folder, "hotspots"))


@query("serve_map_points", f"SELECT cx AS lat, cy AS lon, crime_count FROM ({HOTSPOTS})")
def serve_map_points(spark: SparkSession, folder: str) -> DataFrame:
    return reads.map_points(published(spark, folder, "hotspots"))

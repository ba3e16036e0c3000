"""Result tables: column order and types, enforced before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published tables; ``run_id`` leads every one of them.
RESULT_TABLES = {
    "crime_trends": "trend_type string, trend_key string, crime_count long",
    "arrest_rates": (
        "primary_type string, district string, race string, total_crimes long, "
        "total_arrests long, arrest_rate double"
    ),
    "violence_stats": (
        "month string, district string, community_area string, total_homicides long, "
        "total_nonfatal_shootings long, gunshot_incidents long, total_incidents long, "
        "gunshot_proportion double"
    ),
    "sex_offender_density": (
        "district string, district_name string, offender_count long, "
        "victim_minor_count long, density_rank int"
    ),
    "hotspots": (
        "cluster_id int, centroid_latitude double, centroid_longitude double, crime_count long"
    ),
    "correlations": (
        "correlation_name string, grouping_key string, x_metric string, y_metric string, "
        "x_value double, y_value double, correlation_value double"
    ),
}


# Every table also tells when its rows were staged.
CREATED = "created_at"


def columns_of(table: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a result table without its run id."""
    if table not in RESULT_TABLES:
        raise ValueError(f"unknown result table: {table}")
    return [tuple(part.split()) for part in RESULT_TABLES[table].split(", ")]


def conform(df: DataFrame, table: str, run_id: str | None = None) -> DataFrame:
    """Contract columns in contract order and type, tagged with the run and the time."""
    run = F.col("run_id") if run_id is None else F.lit(run_id).alias("run_id")
    created = F.col(CREATED) if CREATED in df.columns else F.current_timestamp().alias(CREATED)
    return df.select(run, *(F.col(n).cast(t).alias(n) for n, t in columns_of(table)), created)

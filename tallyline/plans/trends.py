"""Trend counts of incidents by year, month, weekday and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.counting import grain_counts, time_grains


def crime_trends(incidents: DataFrame, moment: str = "event_timestamp", year: str | None = "year") -> DataFrame:
    """One pass over the incidents for all four grains."""
    return grain_counts(incidents, time_grains(F.col(moment), F.col(year) if year else None))

"""From emitted windows to anomaly records, counts, alerts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import values

# The result contracts of the speed layer.
ALERT_COLUMNS = (
    "alert_id", "district", "alert_timestamp", "window_start", "window_end", "event_count",
    "threshold_value", "severity", "message", "source",
)
COUNT_COLUMNS = ("district", "window_start", "window_end", "event_count", "updated_at")


def anomaly_rows(
    emits: DataFrame, key: str, minima: dict[str, int] | None = None, threshold: int = values.THRESHOLD
) -> DataFrame:
    """One record per emitted window; ``severity`` is NULL below all minima.

    Window borders are epoch seconds. The threshold is only carried along.
    """
    return emits.select(
        F.col(key).alias("district"),
        "window_start",
        "window_end",
        "event_count",
        F.lit(int(threshold)).cast("long").alias("threshold_value"),
        values.severity_band(F.col("event_count"), minima).alias("severity"),
    )


def count_rows(anomalies: DataFrame) -> DataFrame:
    """The live count of every emitted window."""
    return anomalies.select(
        "district",
        F.timestamp_seconds("window_start").alias("window_start"),
        F.timestamp_seconds("window_end").alias("window_end"),
        "event_count",
        F.current_timestamp().alias("updated_at"),
    )


def alert_rows(anomalies: DataFrame, source: str = "stream") -> DataFrame:
    """Alerts: the anomalies that have a severity, with id and message."""
    return anomalies.where(F.col("severity").isNotNull()).select(
        values.alert_id(F.col("district"), F.col("window_start"), F.col("window_end")).alias("alert_id"),
        "district",
        F.current_timestamp().alias("alert_timestamp"),
        F.timestamp_seconds("window_start").alias("window_start"),
        F.timestamp_seconds("window_end").alias("window_end"),
        "event_count",
        "threshold_value",
        "severity",
        values.alert_message(F.col("district")).alias("message"),
        F.lit(source).alias("source"),
    )


def alert_documents(alerts: DataFrame) -> DataFrame:
    """Alerts as documents: two fields go by other names there."""
    return alerts.withColumnsRenamed({"alert_timestamp": "timestamp", "threshold_value": "threshold"})


def stream_summary(parsed: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row: messages taken in, refused, windows emitted, alerts raised."""
    emitted = anomalies.agg(F.count(F.lit(1)).alias("n")).scalar()
    raised = anomalies.agg(F.count_if(F.col("severity").isNotNull()).alias("n")).scalar()
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rows_rejected"),
    ).withColumns({"windows_emitted": emitted, "anomalies_detected": raised})

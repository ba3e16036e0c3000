"""Registered offenders per area, where the area comes from incident blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import MISSING_BLOCK, UNMATCHED, area_code, text_key
from tallyline.operators.counting import positive_total
from tallyline.operators.keys import first_per_key, look_up, most_frequent, rank_in_order

# Labels shown for missing names.
NAME_UNAVAILABLE = "District name unavailable"
NO_MATCH = "No district match from block-level approximation"

METRICS = ["offender_count", "victim_minor_count"]


def block_areas(incidents: DataFrame) -> DataFrame:
    """The area seen most often in each block.

    Raw spellings are counted first, and the texts are cleaned per spelling, not
    per incident.
    """
    spelled = incidents.groupBy("block", "district").agg(F.count(F.lit(1)).alias("times"))
    placed = spelled.select(
        text_key(F.col("block")).alias("block_key"), area_code(F.col("district")).alias("district"), "times"
    )
    return most_frequent(placed, "block_key", "district", weight="times")


def offender_blocks(registry: DataFrame) -> DataFrame:
    """Registry rows and flagged rows per block."""
    keyed = registry.select(
        text_key(F.col("block"), MISSING_BLOCK).alias("block_key"),
        F.upper(F.trim(F.col("victim_minor"))).alias("minor"),
    )
    return keyed.groupBy("block_key").agg(
        F.count(F.lit(1)).alias("offender_count"), F.count_if(F.col("minor") == "Y").alias("victim_minor_count")
    )


def area_counts(registry: DataFrame, incidents: DataFrame) -> DataFrame:
    """Counts per derived area; the row with a NULL area holds what had no match."""
    joined = offender_blocks(registry).join(block_areas(incidents), "block_key", "left")
    return joined.groupBy("district").agg(*(F.sum(m).alias(m) for m in METRICS))


def sex_offender_density(registry: DataFrame, dimension: DataFrame, incidents: DataFrame) -> DataFrame:
    """Ranked areas with their names, and one unranked row for the unmatched.

    All counts are ranked at once, the unmatched last, so that they are kept once;
    the rank of the unmatched is not shown.
    """
    order = [F.col("district").isNull().asc(), F.desc("offender_count"), F.asc("district")]
    counts = rank_in_order(area_counts(registry, incidents), order, "density_rank")
    ranked = counts.where(F.col("district").isNotNull())

    names = dimension.select(area_code(F.col("district")).alias("district"), "district_name")
    names = first_per_key(names.where(F.col("district").rlike("^[0-9]{3}$")), ["district"])
    named = look_up(ranked, names, "district", "district_name", NAME_UNAVAILABLE)

    lost = positive_total(counts.where(F.col("district").isNull()), METRICS).select(
        F.lit(UNMATCHED).alias("district"),
        F.lit(NO_MATCH).alias("district_name"),
        *METRICS,
        F.lit(None).cast("int").alias("density_rank"),
    )
    columns = ["district", "district_name", *METRICS, "density_rank"]
    return named.select(*columns).withColumn("density_rank", F.col("density_rank").cast("int")).unionByName(lost)

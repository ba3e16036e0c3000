"""Violence statistics by month, area and community, and the top communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import or_unknown
from tallyline.functions.values import keyword_flag, month_key, set_flag
from tallyline.operators.counting import flag_counts, guarded_ratio, roll_up
from tallyline.operators.keys import top_k

KEYS = ["month", "district", "community_area"]
METRICS = ["total_homicides", "total_nonfatal_shootings", "gunshot_incidents", "total_incidents"]
PROPORTION = "gunshot_proportion"
KEYWORD = "HOMICIDE"


def incident_flags(victims: DataFrame, keyword: str = KEYWORD) -> DataFrame:
    """Keys and the three flags of every victim row; flags may be NULL.

    An unknown homicide flag makes the non-fatal flag unknown too, so such a row
    counts as neither.
    """
    homicide = keyword_flag([F.col("incident_primary"), F.col("victimization_primary")], keyword)
    gunshot = set_flag(F.col("gunshot_injury_i"))
    flagged = victims.withColumns(
        {"is_homicide": homicide, "is_gunshot": gunshot, "is_nonfatal_shooting": gunshot & ~homicide}
    )
    return flagged.withColumns(
        {
            "month": month_key(F.col("event_timestamp"), F.col("month")),
            "district": or_unknown(F.col("district")),
            "community_area": or_unknown(F.col("community_area")),
        }
    )


def with_proportion(stats: DataFrame) -> DataFrame:
    """Gunshot share, recomputed from whatever counts the rows hold."""
    return stats.withColumn(PROPORTION, guarded_ratio(F.col("gunshot_incidents"), F.col("total_incidents")))


def detail_counts(victims: DataFrame, keyword: str = KEYWORD) -> DataFrame:
    """Counts per (month, area, community)."""
    flags = {
        "total_homicides": F.col("is_homicide"),
        "total_nonfatal_shootings": F.col("is_nonfatal_shooting"),
        "gunshot_incidents": F.col("is_gunshot"),
    }
    return flag_counts(incident_flags(victims, keyword), KEYS, flags, "total_incidents")


def top_communities(detail: DataFrame, k: int = 20) -> DataFrame:
    """Communities with most incidents; month and area read ``ALL``."""
    rolled = roll_up(detail, KEYS, ["community_area"], METRICS)
    return top_k(rolled, k, F.desc("total_incidents"), F.asc("community_area"))


def violence_stats(detail: DataFrame, k: int = 20) -> DataFrame:
    """Detail and top communities; the second is summed from the first."""
    return with_proportion(detail.unionByName(top_communities(detail, k)))


def area_violence(detail: DataFrame) -> DataFrame:
    """Incidents per area, summed from the detail."""
    return detail.groupBy("district").agg(F.sum("total_incidents").alias("total_violence"))

"""Two correlations across tables, per area, in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import UNMATCHED
from tallyline.operators.counting import guarded_ratio, share_of_total
from tallyline.operators.rates import rate_of
from tallyline.operators.stats import correlation_rows
from tallyline.session import materialise

# Names of the two correlations.
VIOLENCE_ARREST = "violence_rate_vs_arrest_rate_by_district"
OFFENDER_CRIME = "sex_offender_density_vs_crime_rate_by_district"


def area_metrics(cases: DataFrame, violence: DataFrame) -> DataFrame:
    """Violence and arrest rate per area, zero where a table lacks the area."""
    joined = cases.join(violence, "district", "left").fillna({"total_violence": 0})
    return joined.withColumn("violence_rate", guarded_ratio(F.col("total_violence"), F.col("total_crimes")))


def offender_metrics(cases: DataFrame, density: DataFrame) -> DataFrame:
    """Offender count and share of all cases, per ranked area."""
    shares = share_of_total(cases.select("district", "total_crimes"), "total_crimes", "crime_rate")
    areas = density.where(F.col("district") != UNMATCHED).select(
        "district", F.col("offender_count").cast("double").alias("offender_density")
    )
    return areas.join(shares, "district", "left").fillna({"total_crimes": 0, "crime_rate": 0.0})


def correlations(tally: DataFrame, violence: DataFrame, density: DataFrame) -> DataFrame:
    """Long-form rows of both correlations, over the tally of cases and outcomes, the
    incidents per area, and the offenders per area (ranked or not: neither rank nor
    name is read).

    The metrics are one row per area; they are kept, because the rows and the
    scalar beside them read the same table.
    """
    first = materialise(area_metrics(rate_of(tally, "district"), violence))
    second = offender_metrics(first, density)
    return correlation_rows(first, VIOLENCE_ARREST, "district", "violence_rate", "arrest_rate").unionByName(
        correlation_rows(second, OFFENDER_CRIME, "district", "offender_density", "crime_rate")
    )

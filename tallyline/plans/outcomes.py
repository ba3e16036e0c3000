"""Outcome rates: arrests per case by type, area and class, and the top types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import ALL, or_unknown
from tallyline.operators.keys import first_per_key, usable_key
from tallyline.operators.rates import best_rates, outcome_tally, rate_detail, rate_of

GROUPS = ["primary_type", "district"]
KIND = "race"


def case_facts(incidents: DataFrame) -> DataFrame:
    """One row per case: its number, type and area."""
    keyed = usable_key(incidents.select("case_number", *GROUPS), "case_number")
    named = keyed.select("case_number", *(or_unknown(F.col(g)).alias(g) for g in GROUPS))
    return first_per_key(named, ["case_number"])


def outcome_facts(outcomes: DataFrame) -> DataFrame:
    """Case number and class of every outcome."""
    keyed = usable_key(outcomes.select("case_number", KIND), "case_number")
    return keyed.select("case_number", or_unknown(F.col(KIND)).alias(KIND))


def case_tally(incidents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The small table from which all rates are taken, those of the correlations too."""
    return outcome_tally(case_facts(incidents), outcome_facts(outcomes), "case_number", GROUPS, KIND)


def arrest_rates(tally: DataFrame, k: int = 10) -> DataFrame:
    """Detail rows per (type, area, class), then the k best types with ``ALL`` levels."""
    best = best_rates(rate_of(tally, "primary_type"), "primary_type", k)
    rolled = best.withColumns({"district": F.lit(ALL), "race": F.lit(ALL)})
    return rate_detail(tally, GROUPS, KIND).unionByName(rolled)

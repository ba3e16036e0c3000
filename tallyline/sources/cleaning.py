"""Raw strings to typed columns, driven by small rule tables.

A rule is (output column, input column, kind). The kinds are the functions of
:data:`KINDS`; the five tables below state which columns each clean table has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import text, values

Rule = tuple[str, str, str]

KINDS: dict[str, Callable[[Column], Column]] = {
    "text": text.tidy,
    "upper": lambda c: F.upper(text.tidy(c)),
    "flag": values.lenient_bool,
    "area": text.area_code,
    "number": values.number,
    "integer": values.whole_number,
    "moment": values.parse_time,
}

# Columns of the clean tables.
INCIDENT_RULES: tuple[Rule, ...] = (
    ("crime_id", "id", "text"),
    ("case_number", "case_number", "text"),
    ("event_timestamp", "date", "moment"),
    ("date", "date", "text"),
    ("block", "block", "text"),
    ("iucr", "iucr", "text"),
    ("primary_type", "primary_type", "text"),
    ("description", "description", "text"),
    ("location_description", "location_description", "text"),
    ("arrest", "arrest", "flag"),
    ("domestic", "domestic", "flag"),
    ("beat", "beat", "text"),
    ("district", "district", "area"),
    ("ward", "ward", "text"),
    ("community_area", "community_area", "text"),
    ("fbi_code", "fbi_code", "text"),
    ("x_coordinate", "x_coordinate", "number"),
    ("y_coordinate", "y_coordinate", "number"),
    ("year", "year", "integer"),
    ("updated_on", "updated_on", "moment"),
    ("latitude", "latitude", "number"),
    ("longitude", "longitude", "number"),
    ("location", "location", "text"),
)
OUTCOME_RULES: tuple[Rule, ...] = (
    ("cb_no", "cb_no", "text"),
    ("case_number", "case_number", "text"),
    ("arrest_timestamp", "arrest_date", "moment"),
    ("race", "race", "text"),
    ("charge_1_statute", "charge_1_statute", "text"),
    ("charge_1_description", "charge_1_description", "text"),
    ("charge_1_type", "charge_1_type", "text"),
    ("charge_1_class", "charge_1_class", "text"),
)
VICTIM_RULES: tuple[Rule, ...] = (
    ("case_number", "case_number", "text"),
    ("event_timestamp", "date", "moment"),
    ("block", "block", "text"),
    ("victimization_primary", "victimization_primary", "text"),
    ("incident_primary", "incident_primary", "text"),
    ("gunshot_injury_i", "gunshot_injury_i", "upper"),
    ("zip_code", "zip_code", "text"),
    ("ward", "ward", "text"),
    ("community_area", "community_area", "text"),
    ("district", "district", "area"),
    ("beat", "beat", "text"),
    ("age", "age", "integer"),
    ("sex", "sex", "text"),
    ("race", "race", "text"),
    ("victimization_fbi_cd", "victimization_fbi_cd", "text"),
    ("incident_fbi_cd", "incident_fbi_cd", "text"),
    ("month", "month", "text"),
    ("day_of_week", "day_of_week", "text"),
    ("hour", "hour", "integer"),
    ("latitude", "latitude", "number"),
    ("longitude", "longitude", "number"),
)
REGISTRY_RULES: tuple[Rule, ...] = (
    ("last_name", "last", "text"),
    ("first_name", "first", "text"),
    ("block", "block", "text"),
    ("gender", "gender", "text"),
    ("race", "race", "text"),
    ("birth_date", "birth_date", "moment"),
    ("height", "height", "text"),
    ("weight", "weight", "text"),
    ("victim_minor", "victim_minor", "upper"),
)
DIMENSION_RULES: tuple[Rule, ...] = (
    ("district", "district", "area"),
    ("district_name", "district_name", "text"),
    ("address", "address", "text"),
    ("city", "city", "text"),
    ("state", "state", "text"),
    ("zip", "zip", "text"),
    ("phone", "phone", "text"),
    ("x_coordinate", "x_coordinate", "number"),
    ("y_coordinate", "y_coordinate", "number"),
    ("latitude", "latitude", "number"),
    ("longitude", "longitude", "number"),
)


def apply_rules(raw: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One projection from raw headers to clean columns."""
    named = text.standard_columns(raw)
    return named.select(*(KINDS[kind](F.col(source)).alias(target) for target, source, kind in rules))


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Clean crimes, plus month, weekday and hour of the event time."""
    moment = F.col("event_timestamp")
    typed = apply_rules(raw, INCIDENT_RULES)
    return typed.withColumns(
        {
            "year": F.coalesce(F.year(moment), F.col("year")),
            "month": F.month(moment),
            "day_of_week": values.weekday_of(moment),
            "hour": F.hour(moment),
        }
    )


def clean_outcomes(raw: DataFrame) -> DataFrame:
    """Clean arrests."""
    return apply_rules(raw, OUTCOME_RULES)


def clean_victims(raw: DataFrame) -> DataFrame:
    """Clean violence victims."""
    return apply_rules(raw, VICTIM_RULES)


def clean_registry(raw: DataFrame) -> DataFrame:
    """Clean registered offenders."""
    return apply_rules(raw, REGISTRY_RULES)


def clean_dimension(raw: DataFrame) -> DataFrame:
    """Clean stations: the area dimension."""
    return apply_rules(raw, DIMENSION_RULES)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "crimes": clean_incidents,
    "arrests": clean_outcomes,
    "violence": clean_victims,
    "sex_offenders": clean_registry,
    "police_stations": clean_dimension,
}

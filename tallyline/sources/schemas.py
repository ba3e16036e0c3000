"""Raw column names of the five record files, and of the event message."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Header names in file order. Every raw column is a nullable string.
CRIMES = (
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
    "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
    "Updated On", "Latitude", "Longitude", "Location",
)
ARRESTS = (
    "CB_NO", "CASE NUMBER", "ARREST DATE", "RACE",
    "CHARGE 1 STATUTE", "CHARGE 1 DESCRIPTION", "CHARGE 1 TYPE", "CHARGE 1 CLASS",
    "CHARGE 2 STATUTE", "CHARGE 2 DESCRIPTION", "CHARGE 2 TYPE", "CHARGE 2 CLASS",
    "CHARGE 3 STATUTE", "CHARGE 3 DESCRIPTION", "CHARGE 3 TYPE", "CHARGE 3 CLASS",
    "CHARGE 4 STATUTE", "CHARGE 4 DESCRIPTION", "CHARGE 4 TYPE", "CHARGE 4 CLASS",
    "CHARGES STATUTE", "CHARGES DESCRIPTION", "CHARGES TYPE", "CHARGES CLASS",
)
VIOLENCE = (
    "CASE_NUMBER", "DATE", "BLOCK", "VICTIMIZATION_PRIMARY", "INCIDENT_PRIMARY",
    "GUNSHOT_INJURY_I", "UNIQUE_ID", "ZIP_CODE", "WARD", "COMMUNITY_AREA",
    "STREET_OUTREACH_ORGANIZATION", "AREA", "DISTRICT", "BEAT", "AGE", "SEX", "RACE",
    "VICTIMIZATION_FBI_CD", "INCIDENT_FBI_CD", "VICTIMIZATION_FBI_DESCR",
    "INCIDENT_FBI_DESCR", "VICTIMIZATION_IUCR_CD", "INCIDENT_IUCR_CD",
    "VICTIMIZATION_IUCR_SECONDARY", "INCIDENT_IUCR_SECONDARY",
    "HOMICIDE_VICTIM_FIRST_NAME", "HOMICIDE_VICTIM_MI", "HOMICIDE_VICTIM_LAST_NAME",
    "MONTH", "DAY_OF_WEEK", "HOUR", "LOCATION_DESCRIPTION", "STATE_HOUSE_DISTRICT",
    "STATE_SENATE_DISTRICT", "UPDATED", "LATITUDE", "LONGITUDE", "LOCATION",
)
SEX_OFFENDERS = (
    "LAST", "FIRST", "BLOCK", "GENDER", "RACE", "BIRTH DATE", "HEIGHT", "WEIGHT",
    "VICTIM MINOR",
)
POLICE_STATIONS = (
    "DISTRICT", "DISTRICT NAME", "ADDRESS", "CITY", "STATE", "ZIP", "WEBSITE", "PHONE",
    "FAX", "TTY", "X COORDINATE", "Y COORDINATE", "LATITUDE", "LONGITUDE", "LOCATION",
)

# The fields of one event message, with their kinds.
EVENT_FIELDS = {
    "case_number": "text",
    "date": "text",
    "block": "text",
    "primary_type": "text",
    "district": "area",
    "arrest": "boolean",
    "latitude": "number",
    "longitude": "number",
}


def all_strings(names: tuple[str, ...]) -> StructType:
    """A schema of nullable strings."""
    return StructType([StructField(name, StringType(), True) for name in names])


RAW_SCHEMAS = {
    "crimes": all_strings(CRIMES),
    "arrests": all_strings(ARRESTS),
    "violence": all_strings(VIOLENCE),
    "sex_offenders": all_strings(SEX_OFFENDERS),
    "police_stations": all_strings(POLICE_STATIONS),
}

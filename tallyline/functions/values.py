"""Typed values out of text: times, booleans, numbers, flags, bands and ids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import UNKNOWN, strip, tidy

# The words accepted as booleans and as a set flag.
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")
FLAG_WORDS = ("Y", "YES", "TRUE", "1")

# US-style time formats; ISO forms are read by a plain cast.
US_12_HOUR = "MM/dd/yyyy hh:mm:ss a"
US_24_HOUR = "MM/dd/yyyy HH:mm:ss"

# Default window, slide and severity minima of the alert stream.
WINDOW_SECONDS = 300
SLIDE_SECONDS = 60
THRESHOLD = 25
SEVERITY_MINIMA = {"LOW": 25, "MEDIUM": 40, "HIGH": 60}


def parse_time(value: Column) -> Column:
    """Timestamp from any of the accepted spellings, else NULL.

    The spelling is told by its shape first, so that no parser is tried on text
    that it must reject: a failed parse costs an exception per row. A text without
    a date is no time: a bare time of day would be read as today's.
    """
    text = strip(value)
    us_style = F.when(
        F.upper(text).endswith("M"), F.try_to_timestamp(text, F.lit(US_12_HOUR))
    ).otherwise(F.try_to_timestamp(text, F.lit(US_24_HOUR)))
    dated = F.when(text.rlike(r"^\d{4}-"), text.try_cast("timestamp"))
    return F.when(text.contains("/"), us_style).otherwise(dated)


def lenient_bool(value: Column) -> Column:
    """True for the accepted words, False for anything else, NULL included."""
    return F.coalesce(F.lower(strip(value)).isin(*TRUE_WORDS), F.lit(False))


def strict_bool(value: Column) -> Column:
    """True or False for the accepted words, NULL (reject) for anything else."""
    word = F.lower(strip(value))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def finite(value: Column) -> Column:
    """Is a double neither NaN nor infinite?"""
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def number(value: Column) -> Column:
    """Finite double or NULL."""
    read = strip(value).try_cast("double")
    return F.when(finite(read), read)


def safe_number(value: Column, default: float = 0.0) -> Column:
    """Double, with a default for blank and bad text."""
    return F.coalesce(number(value), F.lit(float(default)))


def whole_number(value: Column) -> Column:
    """Integer or NULL; a fractional part is cut, as in a plain text cast."""
    return number(value).try_cast("int")


def year_of(moment: Column, fallback: Column) -> Column:
    """Year of the time, else the year column."""
    return F.coalesce(F.year(moment), whole_number(fallback))


def weekday_of(moment: Column) -> Column:
    """English weekday name."""
    return F.date_format(moment, "EEEE")


def month_key(moment: Column, raw_month: Column, missing: str = UNKNOWN) -> Column:
    """``yyyy-MM``, else the raw month text, else the sentinel."""
    return F.coalesce(F.date_format(moment, "yyyy-MM"), tidy(raw_month), F.lit(missing))


def keyword_flag(columns: Sequence[Column], word: str) -> Column:
    """Does any column hold the word? Three-valued: NULL when a miss meets a NULL."""
    return reduce(lambda left, right: left | right, (F.upper(tidy(c)).contains(word) for c in columns))


def set_flag(value: Column, words: Sequence[str] = FLAG_WORDS) -> Column:
    """Membership in a fixed word set, after trim and upper; NULL stays NULL."""
    return F.upper(tidy(value)).isin(*words)


def severity_band(count: Column, minima: dict[str, int] | None = None) -> Column:
    """Label of the highest minimum reached, NULL below all of them."""
    ranked = sorted((minima or SEVERITY_MINIMA).items(), key=lambda kv: -kv[1])
    label, least = ranked[0]
    band = F.when(count >= least, F.lit(label))
    for label, least in ranked[1:]:
        band = band.when(count >= least, F.lit(label))
    return band


def compact_utc(epoch_seconds: Column) -> Column:
    """``yyyyMMdd'T'HHmmss`` in UTC (the session zone is pinned)."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyyMMdd'T'HHmmss")


def alert_id(key: Column, window_start: Column, window_end: Column) -> Column:
    """Deterministic id of one key and window, given as epoch seconds."""
    return F.concat_ws("_", key, compact_utc(window_start), compact_utc(window_end))


def alert_message(key: Column, label: str = "Crime spike detected in district ") -> Column:
    """Text shown with an alert."""
    return F.concat(F.lit(label), key)


def event_id(case: Column, date: Column) -> Column:
    """Id of one raw event."""
    return F.concat_ws("_", case, date)


def new_run_id(now: datetime | None = None) -> str:
    """``batch_YYYYMMDD_HHMMSS``, made once on the driver."""
    return (now or datetime.now(timezone.utc)).strftime("batch_%Y%m%d_%H%M%S")

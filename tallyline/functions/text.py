"""Text keys, area codes and column names."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentinels that appear in result tables.
UNKNOWN = "UNKNOWN"
ALL = "ALL"
UNMATCHED = "UNMATCHED"
MISSING_BLOCK = "__MISSING_BLOCK__"


def standard_name(name: str) -> str:
    """Header text as snake_case: the runs of letters and digits, joined by ``_``."""
    return "_".join(re.findall(r"[0-9a-z]+", name.lower()))


def standard_columns(df: DataFrame) -> DataFrame:
    """Rename every column at once; two headers must not fall together."""
    names = [standard_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes or "" in names:
        raise ValueError(f"column names clash or are empty after renaming: {clashes or ['']}")
    return df.toDF(*names)


def tidy(value: Column) -> Column:
    """Text form without outer spaces."""
    return F.trim(value.cast("string"))


def strip(value: Column) -> Column:
    """Text form without any outer white space (event payloads may carry tabs)."""
    return F.trim(value.cast("string"), F.lit(" \t\r\n\f\x0b"))


def has_text(value: Column) -> Column:
    """True when there is something besides white space; never NULL."""
    return F.coalesce(F.length(strip(value)) > 0, F.lit(False))


def area_code(value: Column, width: int = 3, missing: str = UNKNOWN) -> Column:
    """Zero-pad numeric area codes; leave labels and longer codes alone.

    ``7``, ``7.0`` and ``007`` are one area. A trailing ``.0`` goes only when the
    rest is numeric, and a code longer than ``width`` is never cut.
    """
    text = strip(value)
    digits = F.substring_index(text, ".", 1)
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0")
    return (
        F.when(~has_text(value), F.lit(missing))
        .when(text.rlike(r"^[0-9]+(\.0)?$"), padded)
        .otherwise(text)
    )


def text_key(value: Column, missing: str | None = None) -> Column:
    """Comparable text: upper case, outer spaces gone, inner runs of space single."""
    key = F.nullif(F.trim(F.regexp_replace(F.upper(value.cast("string")), r"\s+", " ")), F.lit(""))
    return key if missing is None else F.coalesce(key, F.lit(missing))


def or_unknown(value: Column, missing: str = UNKNOWN) -> Column:
    """Trimmed text with a sentinel for NULL."""
    return F.coalesce(tidy(value), F.lit(missing))


def first_usable(df: DataFrame, aliases: Iterable[str]) -> Column:
    """First non-blank value among those aliases the frame really has."""
    present = [a for a in aliases if a in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.when(has_text(F.col(a)), strip(F.col(a))) for a in present))


def all_present(columns: Iterable[Column]) -> Column:
    """True when every column has text."""
    return reduce(lambda left, right: left & right, (has_text(c) for c in columns), F.lit(True))

"""Edge rows of the column expressions."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyline.functions import text, values


def apply(spark, expression, cells, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_area_code(spark):
    cases = {
        "7": "007", "007": "007", " 12 ": "012", "7.0": "007", "0": "000", "0007": "0007", "1234": "1234",
        "1234.0": "1234", "HQ": "HQ", "HQ.0": "HQ.0", "7.5": "7.5", "": "UNKNOWN", "   ": "UNKNOWN", "\t7\t": "007",
    }
    assert apply(spark, text.area_code, cases) == list(cases.values())
    assert apply(spark, text.area_code, [None]) == ["UNKNOWN"]
    assert apply(spark, text.area_code, [7], "int") == ["007"]


def test_parse_time(spark):
    same = [
        "01/02/2024 03:04:05 PM", "01/02/2024 15:04:05", "2024-01-02T15:04:05.000", "2024-01-02T15:04:05",
        "2024-01-02 15:04:05", " 01/02/2024 03:04:05 pm ",
    ]
    got = apply(spark, lambda v: F.unix_seconds(values.parse_time(v)), same)
    assert got == [int(datetime(2024, 1, 2, 15, 4, 5, tzinfo=timezone.utc).timestamp())] * len(same)
    assert apply(spark, values.parse_time, ["garbage", "", None, "13/45/2024 99:00:00", "13/45/2024 01:00:00 PM", "10:30", "T10:30:00"]) == [None] * 7


def test_booleans(spark):
    true, false, other = ["true", "T", "1", "Yes", " y "], ["false", "0", "n", "No", "f"], ["maybe", "", None]
    assert apply(spark, values.lenient_bool, true + false + other) == [True] * 5 + [False] * 8
    assert apply(spark, values.strict_bool, true + false + other) == [True] * 5 + [False] * 5 + [None] * 3


def test_numbers(spark):
    assert apply(spark, lambda v: values.safe_number(v, -1.0), ["1.5", " 2 ", "", "abc", None, "NaN", "Infinity", "-inf"]) == [1.5, 2.0] + [-1.0] * 6
    assert apply(spark, values.number, ["1.5", "", "abc", None]) == [1.5, None, None, None]
    assert apply(spark, values.whole_number, ["12", "12.7", "-3.9", "x", None, "99999999999"]) == [12, 12, -3, None, None, None]


def test_text_key(spark):
    cells = [" 12xx  n  Main ", "a\tb", "   ", "", None]
    assert apply(spark, lambda v: text.text_key(v, "__MISSING__"), cells) == ["12XX N MAIN", "A B"] + ["__MISSING__"] * 3
    assert apply(spark, text.text_key, ["  ", None]) == [None, None]


@pytest.mark.parametrize(
    "incident,victim,gunshot,homicide,nonfatal",
    [
        ("HOMICIDE", None, "Y", True, False),
        ("BATTERY", None, "Y", None, None),
        ("BATTERY", "BATTERY", "Y", False, True),
        ("BATTERY", "first degree homicide", "N", True, False),
        ("BATTERY", "BATTERY", None, False, None),
    ],
)
def test_three_valued_flags(spark, incident, victim, gunshot, homicide, nonfatal):
    row = spark.createDataFrame([(incident, victim, gunshot)], "a string, b string, g string")
    is_homicide = values.keyword_flag([F.col("a"), F.col("b")], "HOMICIDE")
    got = row.select(is_homicide.alias("h"), (values.set_flag(F.col("g")) & ~is_homicide).alias("n")).first()
    assert (got["h"], got["n"]) == (homicide, nonfatal)


def test_severity_band(spark):
    assert apply(spark, values.severity_band, [24, 25, 39, 40, 59, 60, None], "long") == [
        None, "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", None,
    ]


def test_ids(spark):
    row = spark.range(1).select(
        values.alert_id(F.lit("007"), F.lit(0), F.lit(300)).alias("a"),
        values.alert_message(F.lit("007")).alias("m"),
        values.event_id(F.lit("HX1"), F.lit("2024-01-01")).alias("e"),
    ).first()
    assert row["a"] == "007_19700101T000000_19700101T000500"
    assert row["m"] == "Crime spike detected in district 007"
    assert row["e"] == "HX1_2024-01-01"
    assert values.new_run_id(datetime(2024, 1, 2, 3, 4, 5)) == "batch_20240102_030405"


def test_names(spark):
    names = {
        "Case Number": "case_number", " X  Coordinate ": "x_coordinate", "CHARGE 1 TYPE": "charge_1_type",
        "Arrest?": "arrest", "﻿ID": "id",
    }
    assert [text.standard_name(n) for n in names] == list(names.values())
    with pytest.raises(ValueError, match="clash"):
        text.standard_columns(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_first_usable(spark):
    rows = spark.createDataFrame([(" ", "x"), ("y ", "x"), (None, None)], "a string, b string")
    assert [r[0] for r in rows.select(text.first_usable(rows, ["none", "a", "b"])).collect()] == ["x", "y", None]
    assert rows.select(text.first_usable(rows, ["none"]).alias("o")).first()["o"] is None


def test_month_key(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 3, 1), "09"), (None, " 09 "), (None, None)], "t timestamp, m string"
    )
    assert [r[0] for r in rows.select(values.month_key(F.col("t"), F.col("m"))).collect()] == ["2024-03", "09", "UNKNOWN"]

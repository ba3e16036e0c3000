"""Files and messages: what comes in, what is refused, what is kept."""

import json

import pytest
from pyspark.sql import functions as F

from tallyline.sources import cleaning, events, records, schemas


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "crimes.csv"
    header = ",".join(schemas.CRIMES)
    filled = ['1', ' HX1 ', '01/02/2024 03:04:05 PM', '"001XX, N ""STATE"" ST\nREAR"'] + [""] * 18
    path.write_text(f"{header}\n{','.join(filled)}\n2,HX2\n", encoding="utf-8")
    raw = records.read_dataset(spark, "crimes", str(path))
    assert raw.columns == list(schemas.CRIMES)
    rows = {r["ID"]: r for r in raw.collect()}
    assert rows["1"]["Block"] == '001XX, N "STATE" ST\nREAR'
    assert rows["2"]["Case Number"] == "HX2" and rows["2"]["Location"] is None


def test_csv_single_line_mode(spark, tmp_path):
    path = str(tmp_path / "plain")
    frame = spark.createDataFrame([("a", " b "), (None, 'say "x"')], "p string, q string")
    records.write_csv(frame, path)
    back = records.scan_csv(spark, path, frame.schema, multiline=False)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("a", " b "), (None, 'say "x"')], key=str)


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        records.read_dataset(spark, "weather", "nowhere")


def test_schemas_have_the_stated_width():
    assert {k: len(v.fields) for k, v in schemas.RAW_SCHEMAS.items()} == {
        "crimes": 22, "arrests": 24, "violence": 38, "sex_offenders": 9, "police_stations": 15,
    }


def test_sample_is_repeatable(spark, tmp_path):
    frame = spark.range(100).select(F.format_string("%03d", "id").alias("k")).repartition(7)
    for _ in range(2):
        assert [r["k"] for r in records.first_n(frame, 3, [F.desc("k")]).collect()] == ["099", "098", "097"]


def test_clean_incidents_edges(spark):
    raw = spark.createDataFrame([()] * 2, "").select(
        *(F.lit(None).cast("string").alias(c) for c in schemas.CRIMES)
    ).limit(1)
    blank = cleaning.clean_incidents(raw).first().asDict()
    assert blank["district"] == "UNKNOWN" and blank["arrest"] is False and blank["year"] is None
    filled = raw.withColumns({"Year": F.lit("2003"), "Date": F.lit("never"), "X Coordinate": F.lit("n/a")})
    row = cleaning.clean_incidents(filled).first()
    assert (row["year"], row["month"], row["event_timestamp"], row["x_coordinate"]) == (2003, None, None, None)
    assert len(cleaning.clean_incidents(raw).columns) == 26


def test_clean_widths(spark):
    for name, width in {"arrests": 8, "violence": 21, "sex_offenders": 9, "police_stations": 11}.items():
        raw = spark.createDataFrame([], schemas.RAW_SCHEMAS[name])
        assert len(cleaning.CLEANERS[name](raw).columns) == width


def message(**changes):
    fields = dict(
        case_number="HX1", date="2024-01-02T03:04:05", block="B", primary_type="THEFT", district="7", arrest=True,
        latitude=41.5, longitude="-87.5",
    )
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v != "DROP"})


def test_parse_events(spark):
    cases = {
        message(): None,
        message(arrest=" YES "): None,
        message(district=None): None,
        message(extra={"a": [1, 2]}): None,
        message(district="DROP"): "missing_district",
        message(case_number="  "): "missing_case_number",
        message(latitude=None): "missing_latitude",
        message(arrest=None): "missing_arrest",
        message(arrest="maybe"): "bad_arrest",
        message(longitude="west"): "bad_longitude",
        "not json": "not_json",
        "": "not_json",
        "[1, 2]": "not_json",
        message()[:30]: "not_json",
    }
    lines = spark.createDataFrame([(c,) for c in cases], "value string")
    got = {r["value"]: r for r in events.parse_events(lines).collect()}
    assert {k: r[events.REJECT] for k, r in got.items()} == cases
    assert got[message()]["district"] == "007" and got[message()]["longitude"] == -87.5
    assert got[message(district=None)]["district"] == "UNKNOWN"
    parsed = events.parse_events(lines)
    assert events.accepted(parsed).count() + events.quarantined(parsed).count() == len(cases)


def test_event_rows_drop_incomplete(spark):
    frame = spark.createDataFrame(
        [("HX1", "01/01/2024 01:00:00 AM", "B", "THEFT", "7.0", "1", "x"), ("HX2", None, "B", "THEFT", None, None, None)],
        "`CASE NUMBER` string, `DATE` string, `BLOCK` string, `PRIMARY TYPE` string, `BEAT` string, `ARREST` string, `LATITUDE` string",
    )
    rows = events.event_rows(frame, aliases={"district": ("district", "beat")}).collect()
    assert len(rows) == 1
    assert rows[0].asDict() == {
        "case_number": "HX1", "date": "01/01/2024 01:00:00 AM", "block": "B", "primary_type": "THEFT",
        "district": "007", "arrest": True, "latitude": 0.0, "longitude": 0.0,
    }


def test_event_time_falls_back_to_arrival(spark):
    frame = spark.createDataFrame([("2024-01-02T03:04:05",), ("?",)], "date string")
    got = frame.select(events.event_time(F.col("date")).alias("t"), F.current_timestamp().alias("now")).collect()
    assert got[0]["t"].year == 2024 and got[1]["t"] == got[1]["now"]
    with pytest.raises(ValueError):
        events.event_time(F.col("date"), "ingest")
    arrived = F.lit("2030-01-01 00:00:00").cast("timestamp")
    for basis, years in (("event", [2024, 2030]), ("arrival", [2030, 2030])):
        assert [r["t"].year for r in frame.select(events.event_time(F.col("date"), basis, arrived).alias("t")).collect()] == years
    # Without a time from the source, the time of processing is not taken for the arrival.
    assert frame.select(events.event_time(F.col("date"), "arrival").alias("t")).first()["t"].year == 2024


def test_retention(spark):
    log = spark.createDataFrame([(0,), (86400,), (86399,)], "s long").select(F.timestamp_seconds("s").alias("ingested_at"))
    assert events.retained(log, F.timestamp_seconds(F.lit(172800))).count() == 1

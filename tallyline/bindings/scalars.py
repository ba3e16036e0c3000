"""Scalar expressions over whole tables, in many spellings of the same value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.registry import query
from tallyline.bindings.tables import EVENT_FIELDS, MINIMA, VICTIM_KEYWORD, VICTIMS, SIZE, SLIDE, event_lines, stamp, table, victims
from tallyline.functions import text, values
from tallyline.operators.hops import hop_counts
from tallyline.plans.incidents import incident_flags
from tallyline.sources.events import event_time, parse_events

# The same text in Spark SQL and in the oracle.
RAW_AREA = """CASE o_orderkey % 9
    WHEN 0 THEN CAST(o_custkey AS VARCHAR(20)) WHEN 1 THEN ' ' || CAST(o_custkey AS VARCHAR(20)) || ' '
    WHEN 2 THEN CAST(o_custkey AS VARCHAR(20)) || '.0' WHEN 3 THEN '00' || CAST(o_custkey AS VARCHAR(20))
    WHEN 4 THEN CAST(o_custkey % 90 AS VARCHAR(20)) WHEN 5 THEN 'HQ.0' WHEN 6 THEN 'HQ ' || o_orderstatus
    WHEN 7 THEN '  ' END"""


@query(
    "area_code",
    f"""
    WITH raw AS (SELECT o_orderkey, trim({RAW_AREA}) AS v FROM orders),
    cut AS (SELECT o_orderkey, v, CASE WHEN regexp_matches(v, '^[0-9]+(\\.0)?$') THEN regexp_replace(v, '\\.0$', '') END AS d FROM raw)
    SELECT o_orderkey,
           CASE WHEN COALESCE(v, '') = '' THEN 'UNKNOWN' WHEN d IS NULL THEN v
                WHEN length(d) < 3 THEN lpad(d, 3, '0') ELSE d END AS area
    FROM cut
    """,
)
def area_code(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", text.area_code(F.expr(RAW_AREA)).alias("area"))


@query(
    "parse_time",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 8 < 5
                THEN strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') END AS parsed
    FROM orders
    """,
)
def parse_time(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    moment = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + key % 86400)
    spellings = [
        "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd HH:mm:ss",
    ]
    raw = F.lit(None).cast("string")
    for i, spelling in enumerate(spellings):
        raw = F.when(key % 8 == i, F.concat(F.lit(" "), F.date_format(moment, spelling), F.lit(" "))).otherwise(raw)
    bare = F.date_format(moment, "HH:mm")  # a time of day alone is no time
    raw = F.when(key % 8 == 5, F.lit("garbage")).when(key % 8 == 6, F.when(key % 16 == 6, F.lit("")).otherwise(bare)).otherwise(raw)
    return table(spark, folder, "orders").select("o_orderkey", stamp(values.parse_time(raw)).alias("parsed"))


RAW_WORD = """CASE o_orderkey % 12
    WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN '1' WHEN 3 THEN 'Yes' WHEN 4 THEN ' y ' WHEN 5 THEN 'false'
    WHEN 6 THEN '0' WHEN 7 THEN 'maybe' WHEN 8 THEN '' WHEN 9 THEN 'No' WHEN 10 THEN ' F' END"""


@query(
    "lenient_bool",
    f"""
    WITH raw AS (SELECT o_orderkey, lower(trim({RAW_WORD})) AS w FROM orders)
    SELECT o_orderkey, COALESCE(w IN ('true', 't', '1', 'yes', 'y'), false) AS lenient,
           CASE WHEN w IN ('true', 't', '1', 'yes', 'y') THEN true
                WHEN w IN ('false', 'f', '0', 'no', 'n') THEN false END AS strict
    FROM raw
    """,
)
def lenient_bool(spark: SparkSession, folder: str) -> DataFrame:
    word = F.expr(RAW_WORD)
    return table(spark, folder, "orders").select(
        "o_orderkey", values.lenient_bool(word).alias("lenient"), values.strict_bool(word).alias("strict")
    )


@query(
    "safe_number",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN o_totalprice ELSE 0.0 END AS number,
           CASE WHEN o_orderkey % 5 < 2 THEN CAST(trunc(o_totalprice) AS INTEGER) END AS whole
    FROM orders
    """,
)
def safe_number(spark: SparkSession, folder: str) -> DataFrame:
    key, price = F.col("o_orderkey") % 5, F.col("o_totalprice").cast("string")
    raw = F.when(key == 0, price).when(key == 1, F.concat(F.lit(" "), price, F.lit(" ")))
    raw = raw.when(key == 2, F.lit("")).when(key == 3, F.when(F.col("o_orderkey") % 2 == 0, F.lit("abc")).otherwise(F.lit("NaN")))
    raw = raw.when((key == 4) & (F.col("o_orderkey") % 2 == 0), F.lit("-Infinity"))
    return table(spark, folder, "orders").select(
        "o_orderkey", values.safe_number(raw).alias("number"), values.whole_number(raw).alias("whole")
    )


@query(
    "text_key",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '__MISSING_BLOCK__'
                           ELSE upper(p_name || ' ' || p_type) END AS block_key
    FROM part
    """,
)
def text_key(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    padded = F.concat(F.lit(" "), F.col("p_name"), F.repeat(F.lit(" "), (key % 3 + 1).cast("int")), F.col("p_type"), F.lit("  "))
    raw = F.when(key % 14 == 0, F.lit("   ")).when(key % 7 != 0, padded)
    return table(spark, folder, "part").select("p_partkey", text.text_key(raw, text.MISSING_BLOCK).alias("block_key"))


@query(
    "date_parts",
    """
    SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN 1999 ELSE year(ts) END AS INTEGER) AS year,
           CAST(CASE WHEN event_id % 5 <> 0 THEN month(ts) END AS INTEGER) AS month,
           CASE WHEN event_id % 5 <> 0 THEN dayname(ts) END AS day_of_week,
           CAST(CASE WHEN event_id % 5 <> 0 THEN hour(ts) END AS INTEGER) AS hour
    FROM events
    """,
)
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    moment = F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        "event_id",
        values.year_of(moment, F.lit("1999")).alias("year"),
        F.month(moment).alias("month"),
        values.weekday_of(moment).alias("day_of_week"),
        F.hour(moment).alias("hour"),
    )


@query(
    "incident_flags",
    f"""
    SELECT l_orderkey, l_linenumber, month, district, community_area, is_homicide, is_gunshot,
           is_gunshot AND NOT is_homicide AS is_nonfatal_shooting
    FROM ({VICTIMS})
    """,
)
def flags(spark: SparkSession, folder: str) -> DataFrame:
    return incident_flags(victims(spark, folder), VICTIM_KEYWORD).select(
        "l_orderkey", "l_linenumber", "month", "district", "community_area", "is_homicide", "is_gunshot",
        "is_nonfatal_shooting",
    )


HOPS = f"""
    SELECT event_type, w AS start_s, count(*) AS event_count FROM (
        SELECT event_type, unnest(generate_series(
            CAST(floor(epoch(ts)) AS BIGINT) // {SLIDE} * {SLIDE} - {SIZE} + {SLIDE},
            CAST(floor(epoch(ts)) AS BIGINT) // {SLIDE} * {SLIDE}, {SLIDE})) AS w
        FROM events)
    GROUP BY 1, 2
"""


@query(
    "severity_band",
    f"""
    SELECT event_type, strftime(make_timestamp(start_s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, event_count,
           CASE WHEN event_count >= 8 THEN 'HIGH' WHEN event_count >= 6 THEN 'MEDIUM'
                WHEN event_count >= 4 THEN 'LOW' END AS severity
    FROM ({HOPS})
    """,
)
def severity_band(spark: SparkSession, folder: str) -> DataFrame:
    counts = hop_counts(table(spark, folder, "events"), "event_type", "ts", SIZE, SLIDE)
    return counts.select(
        "event_type",
        stamp("window_start").alias("window_start"),
        "event_count",
        values.severity_band(F.col("event_count"), MINIMA).alias("severity"),
    )


@query(
    "stream_event_time",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           strftime(CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y-%m-%d %H:%M:%S') AS event_time
    FROM events
    """,
)
def stream_event_time(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh date cannot be read; the arrival, a day later, stands in."""
    later = F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    parsed = parse_events(event_lines(spark, folder, more={"arrived": later}), EVENT_FIELDS)
    unread = F.col("event_id").cast("long") % 7 == 0
    odd = F.when(F.col("event_id").cast("long") % 2 == 0, F.lit("10:30")).otherwise(F.lit("some day"))
    date = F.when(unread, odd).otherwise(F.col("date"))
    return parsed.select("event_id", stamp(event_time(date, "event", F.col("arrived"))).alias("event_time"))

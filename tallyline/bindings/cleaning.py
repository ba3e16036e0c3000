"""Sources and cleaning over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.registry import query
from tallyline.bindings.tables import EVENT_FIELDS, event_lines, stamp, table
from tallyline.functions.text import first_usable as usable
from tallyline.functions.text import standard_columns as renamed
from tallyline.operators.clusters import valid_points as with_coordinates
from tallyline.session import scratch_path
from tallyline.sources import cleaning, events, records, schemas, splitcsv
from tallyline.sources.schemas import RAW_SCHEMAS


def raw_frame(df: DataFrame, dataset: str, filled: dict[str, Column]) -> DataFrame:
    """Columns of a raw file: the filled ones as text, the others NULL."""
    return df.select(
        *(filled.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in RAW_SCHEMAS[dataset].fields)
    )


def raw_crimes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers in the shape of the crimes file."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    key, nation = F.col("o_orderkey"), F.col("c_nationkey").cast("string")
    moment = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + key % 86400)
    us_date = F.date_format(moment, "MM/dd/yyyy hh:mm:ss a")
    return raw_frame(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
        "crimes",
        {
            "ID": F.concat(F.lit(" "), key.cast("string")),
            "Case Number": F.concat(F.lit("HX"), key.cast("string"), F.lit(" ")),
            "Date": F.when(key % 11 != 0, us_date),
            "Block": F.col("c_name"),
            "Primary Type": F.concat(F.lit(" "), F.col("o_orderpriority")),
            "Description": F.concat(F.lit('say "'), F.col("c_mktsegment"), F.lit('",\nthen go')),
            "Arrest": F.when(key % 2 == 0, F.lit("True")).otherwise(F.lit("no")),
            "Domestic": F.when(key % 3 == 0, F.lit(" Y")),
            "District": F.when(key % 13 == 0, F.lit("")).otherwise(F.concat(nation, F.when(key % 2 == 0, F.lit(".0")).otherwise(F.lit("")))),
            "X Coordinate": F.when(key % 5 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
            "Year": F.date_format(moment, "yyyy"),
            "Updated On": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
            "Latitude": F.when(key % 7 == 0, F.lit("")).otherwise(F.col("c_acctbal").cast("string")),
            "Longitude": F.col("o_totalprice").cast("string"),
        },
    )


CLEAN_COLUMNS = [
    "crime_id", "case_number", "event_timestamp", "block", "primary_type", "description", "arrest", "domestic",
    "district", "x_coordinate", "year", "updated_on", "latitude", "longitude", "month", "day_of_week", "hour", "ward",
]

CLEAN_CRIMES = """
    WITH base AS (
        SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS full_time,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) END AS moment
        FROM orders JOIN customer ON o_custkey = c_custkey
    )
    SELECT CAST(o_orderkey AS VARCHAR) AS crime_id, 'HX' || CAST(o_orderkey AS VARCHAR) AS case_number,
           strftime(moment, '%Y-%m-%d %H:%M:%S') AS event_timestamp, c_name AS block, o_orderpriority AS primary_type,
           'say "' || c_mktsegment || '",' || chr(10) || 'then go' AS description,
           o_orderkey % 2 = 0 AS arrest, o_orderkey % 3 = 0 AS domestic,
           CASE WHEN o_orderkey % 13 = 0 THEN 'UNKNOWN' ELSE lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS district,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS x_coordinate,
           CAST(year(full_time) AS INTEGER) AS year,
           strftime(full_time, '%Y-%m-%d %H:%M:%S') AS updated_on,
           CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal END AS latitude, o_totalprice AS longitude,
           CAST(month(moment) AS INTEGER) AS month, dayname(moment) AS day_of_week, CAST(hour(moment) AS INTEGER) AS hour,
           CAST(NULL AS VARCHAR) AS ward
    FROM base
"""


def _shown(clean: DataFrame) -> DataFrame:
    stamped = clean.withColumns({c: stamp(c) for c in ("event_timestamp", "updated_on")})
    return stamped.select(*CLEAN_COLUMNS)


@query("clean_incidents", CLEAN_CRIMES)
def clean_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(cleaning.clean_incidents(raw_crimes(spark, folder)))


@query("csv_scan", CLEAN_CRIMES)
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write a crimes file, read it back under its schema, clean it."""
    path = scratch_path(spark, "crimes-csv")
    records.write_csv(raw_crimes(spark, folder), path)
    return _shown(cleaning.clean_incidents(records.read_dataset(spark, "crimes", path)))


@query(
    "csv_scan_text",
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest
    FROM documents
    """,
)
def csv_scan_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes, commas and line breaks through a CSV file."""
    path = scratch_path(spark, "documents-csv")
    columns = ("doc_id", "lang", "source", "text")
    documents = table(spark, folder, "documents")
    records.write_csv(documents.select(*(F.col(c).cast("string") for c in columns)), path)
    scanned = records.scan_csv(spark, path, schemas.all_strings(columns))
    return scanned.select("doc_id", "lang", "source", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query(
    "csv_scan_split",
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest
    FROM documents
    """,
)
def csv_scan_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same texts from files of many splits each, dealt over many tasks although their fields hold line breaks."""
    path = scratch_path(spark, "documents-split-csv")
    columns = ("doc_id", "lang", "source", "text")
    documents = table(spark, folder, "documents")
    records.write_csv(documents.select(*(F.col(c).cast("string") for c in columns)), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # splits of a small file; only while it is read
    try:
        scanned = splitcsv.scan_split(spark, path, schemas.all_strings(columns))
        shown = scanned.select("doc_id", "lang", "source", F.length("text").alias("chars"), F.md5("text").alias("digest"))
        return records.to_parquet(shown, scratch_path(spark, "scanned"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query(
    "sample_first_n",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500",
)
def sample_first_n(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return records.first_n(orders, 500, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "standard_columns",
    "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status, o_totalprice AS total_price_usd FROM orders",
)
def standard_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return renamed(orders.toDF(" Order  KEY ", "CUST-KEY", "order_status?", "Total Price (USD)"))


@query(
    "clean_outcomes",
    """
    SELECT CAST(l_partkey AS VARCHAR) AS cb_no, CAST(l_orderkey AS VARCHAR) AS case_number,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS arrest_timestamp, l_linestatus AS race,
           CAST(l_suppkey AS VARCHAR) AS charge_1_statute, CAST(NULL AS VARCHAR) AS charge_1_description,
           l_returnflag AS charge_1_type, CAST(l_linenumber AS VARCHAR) AS charge_1_class
    FROM lineitem
    """,
)
def clean_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_frame(
        table(spark, folder, "lineitem"),
        "arrests",
        {
            "CB_NO": F.col("l_partkey"),
            "CASE NUMBER": F.concat(F.lit("  "), F.col("l_orderkey").cast("string")),
            "ARREST DATE": F.date_format("l_shipdate", "MM/dd/yyyy HH:mm:ss"),
            "RACE": F.concat(F.col("l_linestatus"), F.lit(" ")),
            "CHARGE 1 STATUTE": F.col("l_suppkey"),
            "CHARGE 1 TYPE": F.col("l_returnflag"),
            "CHARGE 1 CLASS": F.col("l_linenumber"),
            "CHARGE 2 CLASS": F.lit("not kept"),
        },
    )
    clean = cleaning.clean_outcomes(raw)
    return clean.withColumn("arrest_timestamp", stamp("arrest_timestamp"))


@query(
    "clean_victims",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS case_number,
           CASE WHEN l_linenumber <> 7 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
           CAST(NULL AS VARCHAR) AS block, p_type AS incident_primary,
           CASE WHEN l_returnflag = 'A' THEN p_type END AS victimization_primary,
           CASE WHEN l_linestatus = 'O' THEN 'Y' END AS gunshot_injury_i,
           lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS district, p_brand AS community_area,
           CASE WHEN l_linenumber <> 3 THEN CAST(trunc(l_quantity) AS INTEGER) END AS age,
           '0' || CAST(l_linenumber - 1 AS VARCHAR) AS month, CAST(l_linenumber AS INTEGER) AS hour, l_discount AS latitude
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def clean_victims(spark: SparkSession, folder: str) -> DataFrame:
    lines, part, supplier = (table(spark, folder, n) for n in ("lineitem", "part", "supplier"))
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    number = F.col("l_linenumber")
    raw = raw_frame(
        joined,
        "violence",
        {
            "CASE_NUMBER": F.col("l_orderkey"),
            "DATE": F.when(number == 7, F.lit("not a date")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")),
            "INCIDENT_PRIMARY": F.concat(F.lit(" "), F.col("p_type")),
            "VICTIMIZATION_PRIMARY": F.when(F.col("l_returnflag") == "A", F.col("p_type")),
            "GUNSHOT_INJURY_I": F.when(F.col("l_linestatus") == "O", F.lit(" y")),
            "DISTRICT": F.concat(F.col("s_nationkey").cast("string"), F.lit(".0")),
            "COMMUNITY_AREA": F.col("p_brand"),
            "AGE": F.when(number == 3, F.lit("old")).otherwise(F.col("l_quantity").cast("string")),
            "MONTH": F.concat(F.lit("0"), (number - 1).cast("string")),
            "HOUR": number,
            "LATITUDE": F.col("l_discount"),
        },
    )
    clean = cleaning.clean_victims(raw).withColumn("event_timestamp", stamp("event_timestamp"))
    return clean.select(
        "case_number", "event_timestamp", "block", "incident_primary", "victimization_primary", "gunshot_injury_i",
        "district", "community_area", "age", "month", "hour", "latitude",
    )


@query(
    "clean_registry",
    """
    SELECT s_name AS last_name, CAST(s_suppkey AS VARCHAR) AS first_name,
           CASE WHEN s_suppkey % 10 = 1 THEN 'NOWHERE' WHEN s_suppkey % 10 = 0 THEN '' ELSE 'supp  ' || CAST(s_suppkey AS VARCHAR) END AS block,
           CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS race,
           '1970-01-02 00:00:00' AS birth_date, CAST(NULL AS VARCHAR) AS height, CAST(NULL AS VARCHAR) AS weight,
           CASE WHEN s_acctbal < 0 THEN 'Y' END AS victim_minor
    FROM supplier
    """,
)
def clean_registry(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    block = F.when(key % 10 == 0, F.lit("  ")).when(key % 10 == 1, F.lit("NOWHERE"))
    raw = raw_frame(
        table(spark, folder, "supplier"),
        "sex_offenders",
        {
            "LAST": F.col("s_name"),
            "FIRST": key,
            "BLOCK": block.otherwise(F.concat(F.lit(" supp  "), key.cast("string"))),
            "BIRTH DATE": F.lit("01/02/1970 12:00:00 AM"),
            "VICTIM MINOR": F.when(F.col("s_acctbal") < 0, F.lit(" y ")),
        },
    )
    return cleaning.clean_registry(raw).withColumn("birth_date", stamp("birth_date"))


@query(
    "clean_dimension",
    """
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS district, n_name AS district_name,
           CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
           CAST(NULL AS VARCHAR) AS zip, CAST(NULL AS VARCHAR) AS phone, CAST(n_regionkey AS DOUBLE) AS x_coordinate,
           CAST(NULL AS DOUBLE) AS y_coordinate, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
    FROM nation
    """,
)
def clean_dimension(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_frame(
        table(spark, folder, "nation"),
        "police_stations",
        {
            "DISTRICT": F.col("n_nationkey"),
            "DISTRICT NAME": F.concat(F.col("n_name"), F.lit("  ")),
            "X COORDINATE": F.col("n_regionkey"),
            "LATITUDE": F.lit("unknown"),
        },
    )
    return cleaning.clean_dimension(raw)


@query(
    "first_usable",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 1 THEN o_orderpriority
                            WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS district
    FROM orders
    """,
)
def first_usable(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    frame = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, F.concat(F.col("o_orderstatus"), F.lit(" "))).when(key % 3 == 1, F.lit("  ")).alias("area"),
        F.when(key % 3 == 1, F.col("o_orderpriority")).otherwise(F.lit("")).alias("beat"),
        F.when(key % 2 == 0, F.col("o_custkey").cast("string")).alias("ward"),
    )
    return frame.select("o_orderkey", usable(frame, ["district", "area", "beat", "ward"]).alias("district"))


ORDER_EVENTS = """
    SELECT 'HX' || CAST(o_orderkey AS VARCHAR) AS case_number,
           strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%m/%d/%Y %I:%M:%S %p') AS date,
           c_name AS block, o_orderpriority AS primary_type,
           CASE WHEN o_orderkey % 13 = 0 THEN 'UNKNOWN' ELSE lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS district,
           o_orderkey % 2 = 0 AS arrest, CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal ELSE 0.0 END AS latitude,
           o_totalprice AS longitude
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 <> 0
"""


@query("required_fields", ORDER_EVENTS)
def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_rows(raw_crimes(spark, folder))


@query("event_publish", ORDER_EVENTS)
def event_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Publish the incidents as messages and take them in again."""
    path = scratch_path(spark, "messages")
    events.publish(events.to_messages(events.event_rows(raw_crimes(spark, folder))), "text", path)
    return events.accepted(events.parse_events(spark.read.text(path)))


PARSED = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') AS district,
           event_id % 3 = 0 AS arrest, value AS latitude,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS longitude
    FROM events
"""


@query("stream_parse", f"{PARSED} WHERE event_id % 50 > 3")
def stream_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = events.parse_events(event_lines(spark, folder, broken=True), EVENT_FIELDS)
    return events.accepted(parsed).drop("date")


@query(
    "quarantine",
    """
    SELECT CASE event_id % 50 WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing_event_type' WHEN 2 THEN 'bad_arrest'
                              ELSE 'bad_latitude' END AS reject_reason,
           CASE WHEN event_id % 50 > 0 THEN CAST(event_id AS VARCHAR) END AS event_id
    FROM events WHERE event_id % 50 <= 3
    """,
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    parsed = events.parse_events(event_lines(spark, folder, broken=True), EVENT_FIELDS)
    refused = events.quarantined(parsed)
    return refused.select("reject_reason", F.when(F.col("reject_reason") != "not_json", F.get_json_object("value", "$.event_id")).alias("event_id"))


@query(
    "valid_points",
    "SELECT l_discount AS latitude, l_tax AS longitude FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0",
)
def valid_points(spark: SparkSession, folder: str) -> DataFrame:
    return with_coordinates(table(spark, folder, "lineitem"), F.col("l_discount"), F.col("l_tax"))

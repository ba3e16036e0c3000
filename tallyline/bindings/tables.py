"""Roles of the operators played by the test tables.

Each role has a Spark frame here and, under the same name, the SQL that gives
the same rows; the oracle queries are built on the latter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.text import area_code

STAMP = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stamp(moment: str | Column) -> Column:
    """Timestamps leave the queries as text, the same in every engine."""
    return F.date_format(F.col(moment) if isinstance(moment, str) else moment, STAMP)


def areas(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Key and area code of every customer or supplier: made before the joins, so once per
    customer or supplier and not once per row that is joined to it."""
    short = name[0]
    return table(spark, folder, name).select(f"{short}_{name[:4]}key", area_code(F.col(f"{short}_nationkey")).alias("district"))


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as incidents, the customer's nation as area."""
    orders, customer = table(spark, folder, "orders"), areas(spark, folder, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    moment = F.col("o_orderdate").cast("timestamp")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("case_number"),
        F.col("o_orderpriority").alias("primary_type"),
        F.col("district"),
        moment.alias("event_timestamp"),
        F.year(moment).alias("year"),
        F.col("o_orderstatus").alias("status"),
    )


def order_moments(spark: SparkSession, folder: str) -> DataFrame:
    """The orders' times alone, for what asks nothing about areas."""
    moment = F.col("o_orderdate").cast("timestamp")
    return table(spark, folder, "orders").select(
        moment.alias("event_timestamp"), F.year(moment).alias("year"), F.col("o_orderstatus").alias("status")
    )


INCIDENTS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS case_number, o_orderpriority AS primary_type,
           lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS district, o_orderdate AS event_timestamp,
           o_orderstatus AS status
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def event_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Events as incidents with a time of day."""
    return table(spark, folder, "events").select(
        F.col("event_id"), F.col("event_type").alias("primary_type"), F.col("ts").cast("timestamp").alias("event_timestamp")
    )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines as outcomes; a case may have both classes."""
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.select(F.col("l_orderkey").cast("string").alias("case_number"), F.col("l_linestatus").alias("race"))


OUTCOMES = """
    SELECT CAST(l_orderkey AS VARCHAR) AS case_number, l_linestatus AS race
    FROM lineitem WHERE l_returnflag = 'R'
"""


def victims(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their part and supplier; times and second keyword may be NULL."""
    lines, part = (table(spark, folder, n) for n in ("lineitem", "part"))
    supplier = areas(spark, folder, "supplier")
    joined = lines.join(part, lines["l_partkey"] == part["p_partkey"]).join(
        supplier, lines["l_suppkey"] == supplier["s_suppkey"]
    )
    return joined.select(
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("timestamp")).alias("event_timestamp"),
        F.concat(F.lit("0"), (F.col("l_linenumber") - 1).cast("string")).alias("month"),
        F.col("district"),
        F.col("p_brand").alias("community_area"),
        F.col("p_type").alias("incident_primary"),
        F.when(F.col("l_returnflag") == "A", F.col("p_type")).alias("victimization_primary"),
        F.when(F.col("l_linestatus") == "O", F.lit("Y")).alias("gunshot_injury_i"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
    )


VICTIM_KEYWORD = "PROMO"

VICTIMS = """
    SELECT l_orderkey, l_linenumber,
           COALESCE(CASE WHEN l_linenumber <> 7 THEN strftime(l_shipdate, '%Y-%m') END,
                    '0' || CAST(l_linenumber - 1 AS VARCHAR)) AS month,
           lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS district, p_brand AS community_area,
           (contains(p_type, 'PROMO') OR
            contains(CASE WHEN l_returnflag = 'A' THEN p_type END, 'PROMO')) AS is_homicide,
           (CASE WHEN l_linestatus = 'O' THEN 'Y' END) IN ('Y', 'YES', 'TRUE', '1') AS is_gunshot
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""


def block_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Lines placed in a supplier block, with the customer's nation as area.

    Orders get their area first, so that the lines, the largest table, are joined once.
    """
    lines, orders, customer = table(spark, folder, "lineitem"), table(spark, folder, "orders"), areas(spark, folder, "customer")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select("o_orderkey", "district")
    joined = lines.join(placed, lines["l_orderkey"] == placed["o_orderkey"])
    return joined.select(F.concat(F.lit("SUPP "), F.col("l_suppkey").cast("string")).alias("block"), "district")


BLOCKS = """
    SELECT 'SUPP ' || CAST(l_suppkey AS VARCHAR) AS block_key,
           lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS district
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as registered persons; some blocks are blank or unknown."""
    key = F.col("s_suppkey")
    block = (
        F.when(key % 10 == 0, F.lit("  "))
        .when(key % 10 == 1, F.lit("NOWHERE"))
        .otherwise(F.concat(F.lit(" supp  "), key.cast("string")))
    )
    minor = F.when(F.col("s_acctbal") < 0, F.lit("Y"))
    return table(spark, folder, "supplier").select(block.alias("block"), minor.alias("victim_minor"))


REGISTRY = """
    SELECT CASE WHEN s_suppkey % 10 = 0 THEN '__MISSING_BLOCK__'
                WHEN s_suppkey % 10 = 1 THEN 'NOWHERE'
                ELSE 'SUPP ' || CAST(s_suppkey AS VARCHAR) END AS block_key,
           CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS minor
    FROM supplier
"""


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as the area dimension; the last five have no name there."""
    name = F.when(F.col("n_nationkey") < 20, F.col("n_name"))
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("district"), name.alias("district_name")
    )


DIMENSION = """
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS district,
           CASE WHEN n_nationkey < 20 THEN n_name END AS district_name
    FROM nation
"""

# Stream settings of the fixture.
SIZE, SLIDE, THRESHOLD = 3600, 600, 4
MINIMA = {"LOW": 4, "MEDIUM": 6, "HIGH": 8}

EVENT_FIELDS = {
    "event_id": "text", "date": "text", "event_type": "text", "district": "area", "arrest": "boolean",
    "latitude": "number", "longitude": "number",
}


def event_line(broken: bool = False) -> Column:
    """An event as a JSON line; with ``broken`` a fixed share of them is damaged."""
    ident = F.col("event_id")
    half = ident % 50
    fields = {
        "event_id": ident.cast("string"),
        "date": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "event_type": F.col("event_type"),
        "district": (F.col("user_id") % 25).cast("string"),
        "arrest": F.when(ident % 3 == 0, F.lit("yes")).otherwise(F.lit("false")),
        "latitude": F.col("value").cast("string"),
        "longitude": F.get_json_object("props", "$.k"),
        "props": F.from_json("props", "k int"),
    }
    if broken:
        fields["event_type"] = F.when(half != 1, fields["event_type"])
        fields["arrest"] = F.when(half == 2, F.lit("maybe")).otherwise(fields["arrest"])
        fields["latitude"] = F.when(half == 3, F.lit("north")).otherwise(fields["latitude"])
    whole = F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))
    return F.when(half == 0, F.substring(whole, 1, 20)).otherwise(whole) if broken else whole


def event_lines(
    spark: SparkSession, folder: str, broken: bool = False, more: dict[str, Column] | None = None
) -> DataFrame:
    """Events as JSON lines, see :func:`event_line`. ``more`` names columns to stand beside the line."""
    beside = [column.alias(name) for name, column in (more or {}).items()]
    return table(spark, folder, "events").select(event_line(broken).alias("value"), *beside)


def emits_sql(source: str = "events") -> str:
    """CTEs ``seconds``, ``steps`` and ``emits``: the throttled trailing windows."""
    return f"""
    seconds AS (
        SELECT event_type AS k, CAST(floor(epoch(ts)) AS BIGINT) AS t, count(*) AS n, min(event_id) AS first_id
        FROM {source} GROUP BY 1, 2
    ),
    counted AS (
        SELECT k, t, n, first_id,
               CAST(COALESCE(sum(n) OVER (PARTITION BY k ORDER BY t
                    RANGE BETWEEN {SIZE} PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS event_count
        FROM seconds
    ),
    steps AS (
        SELECT a.k, a.t, a.first_id, a.event_count, b.t AS nt
        FROM counted a ASOF LEFT JOIN seconds b ON a.k = b.k AND a.t + {SLIDE} <= b.t
    ),
    chain AS (
        SELECT k, min(t) AS t FROM seconds GROUP BY k
        UNION ALL
        SELECT c.k, s.nt FROM chain c JOIN steps s ON c.k = s.k AND c.t = s.t WHERE s.nt IS NOT NULL
    ),
    emits AS (
        SELECT s.k AS district, s.t - {SIZE} AS window_start, s.t AS window_end, s.first_id, s.event_count,
               CASE WHEN s.event_count >= 8 THEN 'HIGH' WHEN s.event_count >= 6 THEN 'MEDIUM'
                    WHEN s.event_count >= 4 THEN 'LOW' END AS severity,
               s.k || '_' || strftime(make_timestamp((s.t - {SIZE}) * 1000000), '%Y%m%dT%H%M%S')
                   || '_' || strftime(make_timestamp(s.t * 1000000), '%Y%m%dT%H%M%S') AS alert_id
        FROM chain c JOIN steps s ON c.k = s.k AND c.t = s.t
    )
    """

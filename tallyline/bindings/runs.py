"""The run protocol: results of the tables, staged and published in a scratch store."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.batch import CELLS, CORRELATIONS, RATE_ROWS, STATS_DETAIL, STATS_TOP, DENSITY, cell_centers, density_rows, rounded, trends_sql, violence
from tallyline.bindings.registry import query
from tallyline.bindings.tables import BLOCKS, VICTIM_KEYWORD, dimension, incidents, order_moments, outcomes, registry, stamp, table, victims
from tallyline.functions.values import new_run_id
from tallyline.operators import clusters
from tallyline.plans import contracts, correlations, incidents as incident_plan, outcomes as outcome_plan
from tallyline.plans.runs import COMPLETED, FAILED, RUNNING, RunStore, ledger_state, row_counts, run_batch
from tallyline.plans.trends import crime_trends
from tallyline.serving import reads
from tallyline.session import materialise, path_exists, scratch_path, write_whole
from tallyline.sources import records
from tallyline.sources.schemas import RAW_SCHEMAS

OLD, NEW, BROKEN, OPEN = (f"batch_2024010{day}_000000" for day in (1, 2, 3, 4))
JOB = "tables"

def _result(spark: SparkSession, folder: str, name: str, run: str) -> DataFrame:
    """A result table; the older run saw only the finished orders."""
    seen = (lambda rows: rows.where(F.col("status") == "F")) if run == OLD else (lambda rows: rows)
    if name == "crime_trends":
        return crime_trends(seen(order_moments(spark, folder)))
    if name == "arrest_rates":
        return outcome_plan.arrest_rates(_tally(spark.sparkContext.applicationId, folder, run))
    if name == "violence_stats":
        return incident_plan.violence_stats(incident_plan.detail_counts(victims(spark, folder), VICTIM_KEYWORD))
    if name == "sex_offender_density":
        return density_rows(spark, folder)
    if name == "hotspots":
        # Not the fit, which no SQL can repeat: centers that are the same on every run.
        lines = table(spark, folder, "lineitem")
        centers = cell_centers(clusters.valid_points(lines, F.col("l_discount"), F.col("l_tax")))
        return centers.toDF("cluster_id", "centroid_latitude", "centroid_longitude", "crime_count")
    tally = _tally(spark.sparkContext.applicationId, folder, run)
    return correlations.correlations(tally, violence(spark, folder), published(spark, folder, "sex_offender_density"))


# As in a batch run: the rates and the correlations of a run share one tally.
@lru_cache(maxsize=None)
def _tally(application: str, folder: str, run: str) -> DataFrame:
    spark = SparkSession.getActiveSession()
    cases = incidents(spark, folder)
    seen = cases.where(F.col("status") == "F") if run == OLD else cases
    return materialise(outcome_plan.case_tally(seen, outcomes(spark, folder)))


# Kept per application and folder: the given tables do not change while a session runs.
@lru_cache(maxsize=None)
def _store(application: str, folder: str) -> RunStore:
    """A store with two completed runs, a failed and an open one; tables come on demand."""
    spark = SparkSession.getActiveSession()
    store = RunStore(spark, scratch_path(spark, "runs"))
    for run, end in ((OLD, COMPLETED), (NEW, COMPLETED), (BROKEN, FAILED), (OPEN, None)):
        store.mark(run, JOB, RUNNING, "started")
        if end:
            store.mark(run, JOB, end, "finished" if end == COMPLETED else "out of space")
    return store


@lru_cache(maxsize=None)
def _publish(application: str, folder: str, name: str) -> None:
    spark = SparkSession.getActiveSession()
    store = _store(application, folder)
    runs = (OLD, NEW) if name in ("crime_trends", "arrest_rates") else (NEW,)
    for run in runs:
        store.stage(_result(spark, folder, name, run), name, run)
        store.publish(run, [name])


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Rows of the newest completed run of a table, through staging and publish."""
    application = spark.sparkContext.applicationId
    _publish(application, folder, name)
    store = _store(application, folder)
    return reads.of_latest_run(store.read(name), ledger_state(store.ledger())).drop(contracts.CREATED)


@query(
    "staged_publish",
    f"""SELECT '{OLD}' AS run_id, * FROM ({trends_sql("(SELECT * FROM orders WHERE o_orderstatus = 'F')", "o_orderdate")})
        UNION ALL SELECT '{NEW}', * FROM ({trends_sql("orders", "o_orderdate")})""",
)
def staged_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Both runs, each staged twice: the second time replaces the first."""
    store = RunStore(spark, scratch_path(spark, "publish"))
    for run in (OLD, NEW):
        result = _result(spark, folder, "crime_trends", run)
        store.stage(result, "crime_trends", run)
        store.stage(result, "crime_trends", run)
        store.publish(run, ["crime_trends"])
        store.publish(run, ["crime_trends"])
    return store.read("crime_trends").drop(contracts.CREATED)


@query(
    "run_generated_id",
    f"""
    SELECT true AS well_formed, true AS in_order, count(*) AS row_count, CAST(sum(crime_count) AS BIGINT) AS total
    FROM ({trends_sql("orders", "o_orderdate")})
    """,
)
def run_generated_id(spark: SparkSession, folder: str) -> DataFrame:
    """A run under an id made for it: the id tells its time, and its rows are found by it."""
    store = RunStore(spark, scratch_path(spark, "generated"))
    run = new_run_id()
    store.stage(_result(spark, folder, "crime_trends", NEW), "crime_trends", run)
    store.publish(run, ["crime_trends"])
    rows = store.read("crime_trends").where(F.col("run_id") == run)
    shape = F.lit(run).rlike("^batch_[0-9]{8}_[0-9]{6}$") & F.try_to_timestamp(F.lit(run), F.lit("'batch_'yyyyMMdd'_'HHmmss")).isNotNull()
    sums = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("crime_count").alias("total"))
    return sums.select(shape.alias("well_formed"), (F.lit(run) > F.lit(NEW)).alias("in_order"), "row_count", "total")


class BrokenStore(RunStore):
    """A store whose publish breaks when one table is written."""

    def _write(self, df: DataFrame, run_id: str, path: str) -> int:
        if "/final/" in path and path_exists(self.spark, f"{self.root}/broken"):
            raise RuntimeError("the job is gone")
        if "/final/" in path:
            write_whole(self.spark, f"{self.root}/broken", "one table is written")
        return super()._write(df, run_id, path)


@query(
    "publish_atomic",
    f"""
    SELECT 'crime_trends' AS table_name, count(*) AS row_count, CAST(sum(crime_count) AS BIGINT) AS total
    FROM ({trends_sql("(SELECT * FROM orders WHERE o_orderstatus = 'F')", "o_orderdate")})
    UNION ALL SELECT 'sex_offender_density', count(*), CAST(sum(offender_count) AS BIGINT) FROM (WITH {DENSITY} SELECT * FROM density)
    """,
)
def publish_atomic(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of a run, published whole; a second publish of it that breaks between the tables changes neither."""
    names = ("crime_trends", "sex_offender_density")
    store = RunStore(spark, scratch_path(spark, "atomic"))
    for name in names:
        store.stage(_result(spark, folder, name, OLD), name, OLD)
    store.publish(OLD, names)
    store.stage(_result(spark, folder, "crime_trends", NEW), "crime_trends", OLD)
    store.stage(_result(spark, folder, "sex_offender_density", NEW).limit(1), "sex_offender_density", OLD)
    try:
        BrokenStore(spark, store.root).publish(OLD, names)
    except RuntimeError:
        pass
    sums = []
    for name, column in (("crime_trends", "crime_count"), ("sex_offender_density", "offender_count")):
        rows = store.read(name).where(F.col("run_id") == OLD)
        total = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum(column).alias("total"))
        sums.append(total.select(F.lit(name).alias("table_name"), "row_count", "total"))
    return reduce(DataFrame.unionByName, sums)


@query(
    "run_row_counts",
    f"""
    SELECT 'crime_trends' AS table_name, count(*) AS row_count FROM ({trends_sql("orders", "o_orderdate")})
    UNION ALL SELECT 'arrest_rates', count(*) FROM ({RATE_ROWS})
    UNION ALL SELECT 'violence_stats', count(*) FROM (SELECT * FROM ({STATS_DETAIL}) UNION ALL SELECT * FROM ({STATS_TOP}))
    UNION ALL SELECT 'sex_offender_density', count(*) FROM (WITH {DENSITY} SELECT * FROM density)
    UNION ALL SELECT 'hotspots', count(*) FROM ({CELLS})
    UNION ALL SELECT 'correlations', count(*) FROM ({CORRELATIONS})
    """,
)
def run_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    for name in contracts.RESULT_TABLES:
        published(spark, folder, name)
    return row_counts(_store(spark.sparkContext.applicationId, folder), NEW)


@query(
    "trend_check",
    f"""SELECT trend_type, count(*) AS rows, CAST(sum(crime_count) AS BIGINT) AS total_count
        FROM ({trends_sql("orders", "o_orderdate")}) GROUP BY 1""",
)
def trend_check(spark: SparkSession, folder: str) -> DataFrame:
    return reads.trend_check(published(spark, folder, "crime_trends"))


def order_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a run: begun on its date, ended by its status."""
    orders = table(spark, folder, "orders")
    begun = F.col("o_orderdate").cast("timestamp")
    end = F.when(F.col("o_orderstatus") == "F", COMPLETED).when(F.col("o_orderstatus") == "O", FAILED)
    ended = F.timestamp_seconds(F.unix_seconds(begun) + F.col("o_custkey"))
    states = F.array(
        F.struct(F.lit(RUNNING).alias("status"), F.lit(0).alias("seq"), begun.alias("at"), F.lit("started").alias("message")),
        F.struct(end.alias("status"), F.lit(1).alias("seq"), ended.alias("at"), F.col("o_orderpriority").alias("message")),
    )
    rows = orders.select(
        F.concat(F.lit("batch_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit(JOB).alias("job_name"),
        F.inline(states),
    )
    return rows.where(F.col("status").isNotNull())


ORDER_RUNS = f"""
    SELECT 'batch_' || CAST(o_orderkey AS VARCHAR) AS run_id, '{JOB}' AS job_name,
           CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'running' END AS status,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN strftime(o_orderdate + to_seconds(o_custkey), '%Y-%m-%d %H:%M:%S') END AS finished_at,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + to_seconds(o_custkey), '%Y-%m-%d %H:%M:%S') END AS last_successful_run,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderpriority ELSE 'started' END AS message
    FROM orders
"""


@query("run_ledger_state", ORDER_RUNS)
def run_ledger_state(spark: SparkSession, folder: str) -> DataFrame:
    states = ledger_state(order_ledger(spark, folder))
    return states.withColumns({c: stamp(c) for c in ("started_at", "finished_at", "last_successful_run")})


RUN_BLOCKS = """
    SELECT 'SUPP ' || CAST(o_custkey % 100 + 1 AS VARCHAR) AS block_key,
           lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS district
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def raw_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw record sets, written as CSV from the tables and read as the job reads them."""
    text = lambda column: column.cast("string")
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    key = F.col("o_orderkey")
    cells = {
        "crimes": placed.select(
            text(key).alias("ID"),
            text(key).alias("Case Number"),
            stamp(F.col("o_orderdate").cast("timestamp")).alias("Date"),
            F.concat(F.lit(" supp  "), text(F.col("o_custkey") % 100 + 1)).alias("Block"),
            F.col("o_orderpriority").alias("Primary Type"),
            text(F.col("c_nationkey")).alias("District"),
            text(41 + (key % 7) / 10).alias("Latitude"),
            text(-87 - (key % 5) / 10).alias("Longitude"),
        ),
        "arrests": outcomes(spark, folder).select(F.col("case_number").alias("CASE NUMBER"), F.col("race").alias("RACE")),
        "violence": victims(spark, folder).select(
            text(F.col("l_orderkey")).alias("CASE_NUMBER"),
            stamp("event_timestamp").alias("DATE"),
            F.col("month").alias("MONTH"),
            F.col("district").alias("DISTRICT"),
            F.col("community_area").alias("COMMUNITY_AREA"),
            F.replace("incident_primary", F.lit(VICTIM_KEYWORD), F.lit("HOMICIDE")).alias("INCIDENT_PRIMARY"),
            F.replace("victimization_primary", F.lit(VICTIM_KEYWORD), F.lit("HOMICIDE")).alias("VICTIMIZATION_PRIMARY"),
            F.col("gunshot_injury_i").alias("GUNSHOT_INJURY_I"),
        ),
        "sex_offenders": registry(spark, folder).select(F.col("block").alias("BLOCK"), F.col("victim_minor").alias("VICTIM MINOR")),
        "police_stations": dimension(spark, folder).select(
            F.col("district").alias("DISTRICT"), F.col("district_name").alias("DISTRICT NAME")
        ),
    }
    raw = {}
    for name, rows in cells.items():
        path = scratch_path(spark, f"raw-{name}")
        shaped = [rows[f"`{f}`"] if f in rows.columns else F.lit(None).cast("string").alias(f) for f in RAW_SCHEMAS[name].names]
        records.write_csv(rows.select(*shaped), path)
        raw[name] = records.read_dataset(spark, name, path)
    return raw


# What is summed up of each table, besides its rows.
RUN_TOTALS = {
    "crime_trends": "crime_count", "arrest_rates": "total_arrests", "violence_stats": "total_incidents",
    "sex_offender_density": "offender_count", "hotspots": "crime_count", "correlations": None,
}

RUN_DENSITY = DENSITY.replace(BLOCKS, RUN_BLOCKS)


@query(
    "batch_run",
    f"""
    SELECT 'crime_trends' AS table_name, count(*) AS row_count, CAST(sum(crime_count) AS BIGINT) AS total
    FROM ({trends_sql("orders", "o_orderdate")})
    UNION ALL SELECT 'arrest_rates', count(*), CAST(sum(total_arrests) AS BIGINT) FROM ({RATE_ROWS})
    UNION ALL SELECT 'violence_stats', count(*), CAST(sum(total_incidents) AS BIGINT)
              FROM (SELECT * FROM ({STATS_DETAIL}) UNION ALL SELECT * FROM ({STATS_TOP}))
    UNION ALL SELECT 'sex_offender_density', count(*), CAST(sum(offender_count) AS BIGINT)
              FROM (WITH {RUN_DENSITY} SELECT * FROM density)
    UNION ALL SELECT 'hotspots', least(10, count(DISTINCT (o_orderkey % 7, o_orderkey % 5))), count(*) FROM orders
    UNION ALL SELECT 'correlations', count(*), count(*) FROM ({CORRELATIONS.replace(BLOCKS, RUN_BLOCKS)})
    """,
)
def batch_run(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run: five raw CSV sets, cleaned, analysed, staged, published; its tables summed up."""
    store = RunStore(spark, scratch_path(spark, "batch-run"))
    run = run_batch(store, raw_files(spark, folder), NEW)
    sums = []
    for name, column in RUN_TOTALS.items():
        total = F.count(F.lit(1)) if column is None else F.sum(column)
        rows = store.read(name).where(F.col("run_id") == run)
        sums.append(rows.agg(F.count(F.lit(1)).alias("row_count"), total.alias("total")).select(F.lit(name).alias("table_name"), "row_count", "total"))
    return reduce(DataFrame.unionByName, sums)

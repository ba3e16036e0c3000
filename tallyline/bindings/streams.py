"""The speed layer: emits, alerts and their sinks, in batch and as real streams."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.registry import query
from tallyline.bindings.scalars import HOPS
from tallyline.bindings.tables import (
    EVENT_FIELDS, MINIMA, SIZE, SLIDE, THRESHOLD, emits_sql, event_line, event_lines, stamp, table,
)
from tallyline.operators import trailing
from tallyline.serving import reads
from tallyline.session import folder_names, scratch_path, set_file_time
from tallyline.sources import events
from tallyline.sources.records import to_parquet
from tallyline.streaming import alerts, sinks, summary, windows


WRITER = "tables"

# All events come in a few batches here, each of which spans a large part of all days.
FOLDERS = "month"


def emitted(spark: SparkSession, folder: str) -> DataFrame:
    """Throttled trailing windows of the events, one key per event type."""
    seconds = trailing.per_second(table(spark, folder, "events"), "event_type", "ts", "event_id")
    return trailing.trailing_emits(seconds, SIZE, SLIDE)


def anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """The emitted windows as anomaly records."""
    return alerts.anomaly_rows(emitted(spark, folder), "key", MINIMA, THRESHOLD)


EMITS = f"WITH RECURSIVE {emits_sql()} SELECT district AS key, window_start, window_end, first_id, event_count FROM emits"
ANOMALIES = f"""
    WITH RECURSIVE {emits_sql()}
    SELECT district, window_start, window_end, event_count, CAST({THRESHOLD} AS BIGINT) AS threshold_value, severity FROM emits
"""


def _alerts_sql(source: str = "stream", threshold: str = "threshold_value") -> str:
    return f"""
    WITH RECURSIVE {emits_sql()}
    SELECT alert_id, district, strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp(window_end * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, event_count,
           CAST({THRESHOLD} AS BIGINT) AS {threshold}, severity,
           'Crime spike detected in district ' || district AS message, '{source}' AS source
    FROM emits WHERE severity IS NOT NULL
    """


def _shown(rows: DataFrame) -> DataFrame:
    """Without the time of writing, which no two runs share."""
    kept = rows.drop("alert_timestamp", "timestamp", "updated_at")
    return kept.withColumns({c: stamp(c) for c in ("window_start", "window_end") if c in kept.columns})


@query("trailing_emits", EMITS)
def trailing_emits(spark: SparkSession, folder: str) -> DataFrame:
    return emitted(spark, folder)


@query("anomaly_rows", ANOMALIES)
def anomaly_rows(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies(spark, folder)


@query("alert_rows", _alerts_sql())
def alert_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(alerts.alert_rows(anomalies(spark, folder)))


# Kept per application and folder: the given tables do not change while a session runs.
@lru_cache(maxsize=None)
def _live(application: str, folder: str) -> sinks.AlertStore:
    """All anomalies saved in one batch, then once more: a replay changes nothing."""
    spark = SparkSession.getActiveSession()
    store = sinks.AlertStore(spark, scratch_path(spark, "live"), FOLDERS)
    rows = to_parquet(anomalies(spark, folder), scratch_path(spark, "anomalies"))
    for _ in range(2):
        store.save(rows, 0, WRITER)
    return store


def live(spark: SparkSession, folder: str) -> sinks.AlertStore:
    return _live(spark.sparkContext.applicationId, folder)


def _like_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "district string, window_start timestamp, window_end timestamp, event_count long, updated_at timestamp")


def _like_alerts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "alert_id string, district string, alert_timestamp timestamp, window_start timestamp, window_end timestamp, "
        "event_count long, threshold_value long, severity string, message string, source string",
    )


@query("alert_documents", _alerts_sql(threshold="threshold"))
def alert_documents(spark: SparkSession, folder: str) -> DataFrame:
    store = live(spark, folder)
    return _shown(store.documents.latest(alerts.alert_documents(_like_alerts(spark))))


@query("serve_live_alerts", f"SELECT * EXCLUDE (window_start, window_end, source) FROM ({_alerts_sql()}) ORDER BY window_end DESC, alert_id LIMIT 100")
def serve_live_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(reads.live_alerts(live(spark, folder).page(_like_alerts(spark), 100), 100))


COUNTS = f"""
    WITH RECURSIVE {emits_sql()}
    SELECT district, strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp(window_end * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, event_count FROM emits
"""


@query("serve_live_counts", f"SELECT * FROM ({COUNTS}) ORDER BY window_end DESC, district, window_start LIMIT 100")
def serve_live_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(reads.live_counts(live(spark, folder).counts.newest(_like_counts(spark), 100)))


def _thirds(rows: DataFrame, ident: str, top: DataFrame) -> DataFrame:
    """Each row's batch: the lower, middle or upper third of the ids."""
    return rows.withColumn("batch", F.least(F.floor(F.col(ident) * 3 / (top.scalar() + 1)), F.lit(2)).cast("int"))


BATCH_OF = "CAST(floor(event_id * 3 / ((SELECT max(event_id) FROM events) + 1)) AS INTEGER)"


@query(
    "upsert_latest",
    f"""
    SELECT event_type AS district, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp((s + 86400) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, event_count
    FROM (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400 AS s, {BATCH_OF} AS batch, count(*) AS event_count,
                 max({BATCH_OF}) OVER (PARTITION BY event_type, CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400) AS last_batch
          FROM events GROUP BY 1, 2, 3)
    WHERE batch = last_batch
    """,
)
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counts in three batches; the last one to have a window wins it."""
    rows = table(spark, folder, "events")
    placed = _thirds(rows, "event_id", rows.agg(F.max("event_id").alias("m")))
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400) * 86400
    counts = placed.groupBy("batch", F.col("event_type").alias("district"), day.alias("s")).agg(F.count(F.lit(1)).alias("event_count"))
    shaped = counts.select(
        "batch", "district", F.timestamp_seconds("s").alias("window_start"),
        F.timestamp_seconds(F.col("s") + 86400).alias("window_end"), "event_count", F.current_timestamp().alias("updated_at"),
    )
    target = sinks.BatchTable(spark, scratch_path(spark, "upsert"), ("district", "window_start", "window_end"), "window_end", span=FOLDERS)
    kept = to_parquet(shaped, scratch_path(spark, "counts"))
    for batch in (0, 1, 1, 2, 2):
        target.upsert(kept.where(F.col("batch") == batch).drop("batch"), batch, WRITER)
    return _shown(target.latest(_like_counts(spark)))


@query(
    "insert_if_absent",
    f"""
    SELECT alert_id, arg_min(source, batch) AS source, CAST(min(batch) AS INTEGER) AS batch FROM (
        SELECT event_type || '_' || strftime(ts, '%Y%m%dT%H') AS alert_id, {BATCH_OF} AS batch, 'batch_' || {BATCH_OF} AS source
        FROM events)
    GROUP BY alert_id
    """,
)
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts per type and hour in three batches, rows doubled; the first one stays."""
    rows = table(spark, folder, "events")
    placed = _thirds(rows, "event_id", rows.agg(F.max("event_id").alias("m")))
    made = placed.select(
        F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMMdd'T'HH")).alias("alert_id"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_end"),
        F.concat(F.lit("batch_"), F.col("batch").cast("string")).alias("source"),
        F.col("batch").alias("third"),
    )
    kept = to_parquet(made, scratch_path(spark, "made"))
    target = sinks.BatchTable(spark, scratch_path(spark, "alerts"), ("alert_id",), "window_end", span=FOLDERS)
    for batch in (0, 1, 1, 2):
        part = kept.where(F.col("third") == batch)
        target.insert_absent(part.unionAll(part), batch, WRITER)
    return target.stored(kept).select("alert_id", "source", F.col("third").alias("batch"))


@query(
    "raw_log_retention",
    """
    SELECT event_type || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_id, event_type, value AS latitude
    FROM events WHERE date_trunc('second', ts) >= (SELECT max(date_trunc('second', ts)) FROM events) - INTERVAL 1 DAY
    """,
)
def raw_log_retention(spark: SparkSession, folder: str) -> DataFrame:
    parsed = events.accepted(events.parse_events(event_lines(spark, folder), EVENT_FIELDS)).drop("event_id")
    log = events.raw_documents(parsed, events.event_time(F.col("date")), "event_type", "date")
    kept = to_parquet(log, scratch_path(spark, "raw-log"))
    newest = kept.agg(F.max("ingested_at").alias("now")).scalar()
    return events.retained(kept, newest).select("event_id", "event_type", "latitude")


@query(
    "stream_summary",
    f"""
    WITH RECURSIVE good AS (SELECT * FROM events WHERE event_id % 50 > 3), {emits_sql("good")}
    SELECT (SELECT count(*) FROM events) AS rows_processed, (SELECT count(*) FROM events WHERE event_id % 50 <= 3) AS rows_rejected,
           (SELECT count(*) FROM emits) AS windows_emitted, (SELECT count(severity) FROM emits) AS anomalies_detected
    """,
)
def stream_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged input: what was taken, refused, emitted and raised; records also go out as JSON lines."""
    parsed = events.parse_events(event_lines(spark, folder, broken=True), EVENT_FIELDS)
    good = timed(events.accepted(parsed))
    seconds = trailing.per_second(good, "event_type", "moment", "event_id")
    rows = alerts.anomaly_rows(trailing.trailing_emits(seconds, SIZE, SLIDE), "key", MINIMA, THRESHOLD)
    path = scratch_path(spark, "anomalies")
    rows.write.json(path)
    shape = "district string, window_start long, window_end long, event_count long, threshold_value long, severity string"
    return alerts.stream_summary(parsed, spark.read.schema(shape).json(path))


@query(
    "stream_live_summary",
    f"""
    WITH RECURSIVE good AS (SELECT * FROM events WHERE event_id % 50 > 3), {emits_sql("good")}
    SELECT (SELECT count(*) FROM events) AS rows_processed, (SELECT count(*) FROM events WHERE event_id % 50 <= 3) AS rows_rejected,
           (SELECT count(*) FROM emits) AS windows_emitted, (SELECT count(severity) FROM emits) AS anomalies_detected,
           CAST(0 AS BIGINT) AS rows_late
    """,
)
def stream_live_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts from the running stream itself, as its listener put them down."""
    watched = summary.StreamSummary(spark, scratch_path(spark, "summary"))
    spark.streams.addListener(watched)
    try:
        lines = _messages(spark, folder, broken=True)
        parsed = summary.observed_intake(events.parse_events(lines, EVENT_FIELDS))
        emits = windows.trailing_stream(timed(events.accepted(parsed)), "event_type", "moment", "event_id", SIZE, SLIDE)
        target = sinks.BatchTable(spark, scratch_path(spark, "emits"), ("key", "window_end"), "at", span=FOLDERS)
        placed = summary.observed_emits(emits, MINIMA).withColumn("at", F.timestamp_seconds("window_end"))
        running = sinks.start_batches(placed, target.upsert, scratch_path(spark, "checkpoint"))
        running.awaitTermination()
        watched.settle(running)
    finally:
        spark.streams.removeListener(watched)
    return watched.totals()


def timed(accepted: DataFrame) -> DataFrame:
    """Accepted events with their event time and a numeric id."""
    return accepted.withColumns(
        {"moment": events.event_time(F.col("date")), "event_id": F.col("event_id").cast("long")}
    )


FEEDS, FEED_ROWS = 8, 100_000


def _topic(spark: SparkSession, folder: str, with_arrival: bool = False, again: Column | None = None, broken: bool = False) -> str:
    """The events as files of JSON lines in time order, written by one job.

    Eight files at least, more where a file would pass ``FEED_ROWS`` rows: ranges of
    (time, id) of about equal size, so events crowded in time are dealt out too. The
    stream takes files by their time of change, which is set in the order of the ranges.
    Lines where ``again`` holds come a second time, behind all others; with ``broken`` a
    fixed share of the lines is damaged.
    """
    path = scratch_path(spark, "topic")
    rows = table(spark, folder, "events")
    feeds = max(FEEDS, -(-rows.count() // FEED_ROWS))
    # Dealt out as plain rows: Spark takes its sample for the ranges of all that stands below them, lines too.
    placed = rows.withColumn("arrived", F.col("ts").cast("timestamp"))
    if again is not None:
        copies = placed.where(again).withColumn("arrived", F.col("arrived") + F.make_dt_interval(F.lit(100_000)))
        placed = placed.unionAll(copies)
    placed = placed.repartitionByRange(feeds, "arrived", "event_id")
    lines = placed.select(event_line(broken).alias("value"), *(["arrived"] if with_arrival else []))
    lines.write.format("json" if with_arrival else "text").save(path)
    for number, name in enumerate(sorted(folder_names(spark, path, "part-"))):
        set_file_time(spark, f"{path}/part-{name}", 1_000_000_000_000 + 1000 * number)
    return path


def _messages(spark: SparkSession, folder: str, with_arrival: bool = False, **kind: Column | bool) -> DataFrame:
    """The topic as a stream. A micro-batch takes an eighth of its files, side by side: what a
    micro-batch costs besides its rows is paid eight times, however many events there are."""
    path = _topic(spark, folder, with_arrival, **kind)
    taken = str(-(-len(folder_names(spark, path, "part-")) // FEEDS))
    fmt, schema = ("json", "value string, arrived timestamp") if with_arrival else ("text", None)
    return events.read_event_stream(spark, fmt, path, schema, maxFilesPerTrigger=taken)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream, one slice of time per micro-batch."""
    return timed(events.accepted(events.parse_events(_messages(spark, folder), EVENT_FIELDS)))


@query(
    "stream_hop_counts",
    f"""
    SELECT event_type, strftime(make_timestamp(start_s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp((start_s + {SIZE}) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, event_count
    FROM ({HOPS})
    """,
)
def stream_hop_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Event-time windows on a stream, updates upserted batch by batch."""
    counts = windows.hop_stream(event_stream(spark, folder), "event_type", "moment", SIZE, SLIDE, "60 days")
    target = sinks.BatchTable(spark, scratch_path(spark, "hops"), ("event_type", "window_start", "window_end"), "window_start", span=FOLDERS)
    running = sinks.start_batches(counts, target.upsert, scratch_path(spark, "checkpoint"), "update")
    running.awaitTermination()
    shape = spark.createDataFrame([], "event_type string, window_start timestamp, window_end timestamp, event_count long")
    return _shown(target.latest(shape))


@query("stream_alerts", _alerts_sql())
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole speed layer on a stream: parse, keyed trailing counter, bands, sinks."""
    emits = windows.trailing_stream(event_stream(spark, folder), "event_type", "moment", "event_id", SIZE, SLIDE)
    store = sinks.AlertStore(spark, scratch_path(spark, "alerts"), FOLDERS)
    running = sinks.start_alerts(emits, store, scratch_path(spark, "checkpoint"), minima=MINIMA, threshold=THRESHOLD)
    running.awaitTermination()
    return _shown(store.alerts.latest(_like_alerts(spark)))


@query("stream_arrival", _alerts_sql())
def stream_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """The speed layer by arrival time: each message carries when it came in, as a Kafka
    source tells it, and its own date says something else."""
    parsed = events.accepted(events.parse_events(_messages(spark, folder, with_arrival=True), EVENT_FIELDS))
    moment = events.event_time(F.lit("2001-01-01 00:00:00"), "arrival", F.col("arrived"))
    placed = parsed.withColumns({"moment": moment, "event_id": F.col("event_id").cast("long")})
    emits = windows.trailing_stream(placed, "event_type", "moment", "event_id", SIZE, SLIDE)
    store = sinks.AlertStore(spark, scratch_path(spark, "arrival"), FOLDERS)
    running = sinks.start_alerts(emits, store, scratch_path(spark, "checkpoint"), minima=MINIMA, threshold=THRESHOLD)
    running.awaitTermination()
    return _shown(store.alerts.latest(_like_alerts(spark)))


@query("stream_counts", COUNTS)
def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The live counts the same stream writes: one per emitted window."""
    emits = windows.trailing_stream(event_stream(spark, folder), "event_type", "moment", "event_id", SIZE, SLIDE)
    store = sinks.AlertStore(spark, scratch_path(spark, "counts"), FOLDERS)
    running = sinks.start_alerts(emits, store, scratch_path(spark, "checkpoint"), minima=MINIMA, threshold=THRESHOLD)
    running.awaitTermination()
    return _shown(store.counts.latest(_like_counts(spark)))


@query(
    "stream_dedupe",
    """
    SELECT alert_id, event_type, hour FROM (
        SELECT event_type || '_' || strftime(ts, '%Y%m%dT%H') AS alert_id, event_type, strftime(ts, '%Y-%m-%d %H:00:00') AS hour
        FROM events)
    GROUP BY ALL
    """,
)
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """One alert per type and hour, told apart in the stream; a third of the events comes twice, far apart."""
    lines = _messages(spark, folder, again=F.col("event_id") % 3 == 0)
    good = timed(events.accepted(events.parse_events(lines, EVENT_FIELDS)))
    raised = good.select(
        F.concat_ws("_", "event_type", F.date_format("moment", "yyyyMMdd'T'HH")).alias("alert_id"),
        "event_type",
        F.date_trunc("hour", "moment").alias("hour"),
    )
    once = windows.once_within(raised, ["alert_id"], "hour", "3650 days")
    target = sinks.BatchTable(spark, scratch_path(spark, "once"), ("alert_id",), "hour", span=FOLDERS)
    sinks.start_batches(once, target.upsert, scratch_path(spark, "checkpoint")).awaitTermination()
    shape = spark.createDataFrame([], once.schema)
    return target.stored(shape).select("alert_id", "event_type", stamp("hour").alias("hour"))


LATE_SECONDS = 7200
LATE_SHARE = 37


@query(
    "stream_late",
    f"""
    WITH timed AS (SELECT event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
    cut AS (SELECT min(t) + (max(t) - min(t)) * 4 // 5 AS cut FROM timed),
    mark AS (SELECT max(t) - {LATE_SECONDS} AS mark FROM timed, cut WHERE t < cut AND event_id % {LATE_SHARE} <> 0),
    told AS (
        SELECT event_type, t // {SIZE} * {SIZE} AS s, (event_id % {LATE_SHARE} = 0 OR t >= cut) AND t < mark AS late FROM timed, cut, mark)
    SELECT event_type, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late
    FROM told GROUP BY event_type, s
    """,
)
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Events on time in windows and the late ones beside them: some come when the watermark has passed them."""
    path = scratch_path(spark, "topic")
    rows = table(spark, folder, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = rows.agg(F.min(second).alias("low"), F.max(second).alias("high")).first()
    cut = span["low"] + (span["high"] - span["low"]) * 4 // 5
    first = (second < cut) & (F.col("event_id") % LATE_SHARE != 0)
    lines = to_parquet(event_lines(spark, folder, more={"first": first}), scratch_path(spark, "lines"))
    for number, part in enumerate((lines.where("first"), lines.where(~F.col("first")))):
        part.select("value").write.text(f"{path}/in={number}")
        for name in folder_names(spark, f"{path}/in={number}", "part-"):
            set_file_time(spark, f"{path}/in={number}/part-{name}", 1_000_000_000_000 + 1000 * number)
    files = len(folder_names(spark, f"{path}/in=0", "part-"))
    given = events.read_event_stream(spark, "text", f"{path}/*", maxFilesPerTrigger=str(files))
    good = timed(events.accepted(events.parse_events(given, EVENT_FIELDS))).select("event_id", "event_type", "moment")
    marked = windows.marked_late(good, "moment", f"{LATE_SECONDS} seconds")
    counts = sinks.BatchTable(spark, scratch_path(spark, "on-time"), ("event_type", "window_start"), "window_start", span=FOLDERS)
    late = scratch_path(spark, "late")
    sinks.start_late_split(marked, counts, late, scratch_path(spark, "checkpoint"), "event_type", "moment", SIZE, SIZE).awaitTermination()
    shape = spark.createDataFrame([], "event_type string, window_start timestamp, window_end timestamp, event_count long")
    on_time = sinks.summed_parts(counts, shape).select("event_type", "window_start", F.col("event_count").alias("on_time"), F.lit(0).cast("long").alias("late"))
    behind = sinks.BatchTable(spark, late, (), "moment", "json").stored(spark.createDataFrame([], good.schema))
    begin = F.timestamp_seconds(F.floor(F.unix_seconds("moment") / SIZE) * SIZE).alias("window_start")
    behind = behind.select("event_type", begin, F.lit(0).cast("long").alias("on_time"), F.lit(1).cast("long").alias("late"))
    both = on_time.unionByName(behind).groupBy("event_type", "window_start").agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"))
    return both.withColumn("window_start", stamp("window_start"))


@query(
    "raw_log_expiry",
    """
    SELECT event_type || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_id, event_type, value AS latitude
    FROM events WHERE date_trunc('second', ts) >= (SELECT max(date_trunc('second', ts)) FROM events) - INTERVAL 1 DAY
    """,
)
def raw_log_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log in two batches after its expiry, run twice: what is stored, without a filter when reading."""
    parsed = events.accepted(events.parse_events(event_lines(spark, folder), EVENT_FIELDS)).drop("event_id")
    kept = to_parquet(events.raw_documents(parsed, events.event_time(F.col("date")), "event_type", "date"), scratch_path(spark, "raw"))
    log = sinks.raw_log(spark, scratch_path(spark, "raw-log"))
    half = F.pmod(F.xxhash64("event_id", "latitude"), F.lit(2))
    for batch in (0, 1):
        log.upsert(kept.where(half == batch), batch, WRITER)
    newest = kept.agg(F.max(F.unix_seconds("ingested_at")).alias("now")).first()["now"]
    for _ in range(2):
        log.expire(datetime.fromtimestamp(newest - 86400, timezone.utc))
    return log.stored(kept).select("event_id", "event_type", "latitude")

"""Jobs for ``spark-submit``: the batch run, the event publisher, the alert stream, the expiry of raw events."""

from __future__ import annotations

import argparse
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions import values
from tallyline.plans.runs import RunStore, run_batch
from tallyline.session import CHECKPOINT_SETTING, build_session, path_exists, remove_path
from tallyline.sources import events, records
from tallyline.sources.schemas import RAW_SCHEMAS
from tallyline.streaming import sinks, summary, windows


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _batch(args: argparse.Namespace) -> None:
    spark = build_session("batch-analytics", args.master, cluster=True)
    work = None
    if spark.conf.get(CHECKPOINT_SETTING, None) is None:
        work = f"{args.work_dir or args.store + '/work'}/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(work)
    try:
        raw = {
            name: records.read_dataset(
                spark, name, getattr(args, name), args.sample_rows, multiline=not args.single_line, fmt=args.input_format
            )
            for name in RAW_SCHEMAS
        }
        print(run_batch(RunStore(spark, args.store), raw, args.run_id, k=args.clusters))
    finally:
        if work:
            remove_path(spark, work)


def _publish(args: argparse.Namespace) -> None:
    spark = build_session("event-publisher", args.master, cluster=True)
    raw = records.read_dataset(spark, "crimes", args.crimes, multiline=not args.single_line, fmt=args.input_format)
    rows = events.event_rows(raw)
    if args.max_rows:
        rows = records.first_n(rows, args.max_rows, [F.col("date"), F.col("case_number")])
    events.publish(events.to_messages(rows, "district" if args.format == "kafka" else None), args.format, args.path, **_options(args.option))


def _alerts(args: argparse.Namespace) -> None:
    spark = build_session("alert-stream", args.master, cluster=True)
    watched = summary.StreamSummary(spark, f"{args.store}/summary")
    spark.streams.addListener(watched)
    for query in start_alert_job(spark, args):
        query.awaitTermination()
        watched.settle(query)


def _expire(args: argparse.Namespace) -> None:
    spark = build_session("raw-log-expiry", args.master, cluster=True)
    expire_raw_log(spark, f"{args.store}/raw_events", datetime.now(timezone.utc) - timedelta(seconds=args.ttl))


def expire_raw_log(spark: SparkSession, path: str, cutoff: datetime) -> None:
    """Drop the raw events that came in before the cutoff."""
    if path_exists(spark, path):
        sinks.raw_log(spark, path).expire(cutoff)


def start_alert_job(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """The alert stream, the stream of refused messages, and the raw log where asked."""
    intake = {"maxOffsetsPerTrigger": str(args.intake)} if args.format == "kafka" else {"maxFilesPerTrigger": "64"}
    lines = events.read_event_stream(spark, args.format, args.path, args.schema, **(intake | _options(args.option)))
    # A source that tells when a message came in (Kafka does) has it in ``timestamp``.
    arrival = F.col("timestamp") if "timestamp" in lines.columns else None
    parsed = events.parse_events(lines.select("value", *(["timestamp"] if arrival is not None else [])))
    good = events.accepted(summary.observed_intake(parsed))
    timed = good.withColumn("moment", events.event_time(F.col("date"), args.time_basis, arrival))
    emits = windows.trailing_stream(timed, "district", "moment", "case_number", args.size, args.slide, args.late)
    minima = dict(zip(("LOW", "MEDIUM", "HIGH"), args.minima))
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    store, beside = sinks.AlertStore(spark, args.store), args.checkpoint.rstrip("/")
    started = [
        sinks.start_alerts(summary.observed_emits(emits, minima), store, args.checkpoint, minima=minima, threshold=args.threshold, trigger=trigger),
        sinks.start_quarantine(events.quarantined(parsed), f"{args.store}/quarantine", f"{beside}-quarantine", trigger),
    ]
    if args.raw_log:
        log = events.raw_documents(events.accepted(parsed), arrival if arrival is not None else F.current_timestamp())
        started.append(sinks.start_raw_log(log, f"{args.store}/raw_events", f"{beside}-raw", trigger=trigger))
    return started


def parser() -> argparse.ArgumentParser:
    """The jobs and their arguments."""
    parser = argparse.ArgumentParser(prog="tallyline", description=__doc__)
    parser.add_argument("--master", help="for a local trial; spark-submit sets it on a cluster")
    jobs = parser.add_subparsers(required=True)

    batch = jobs.add_parser("batch", help="clean, analyse, stage and publish one run")
    for name in RAW_SCHEMAS:
        batch.add_argument(f"--{name}", required=True, help=f"path of the {name} CSV files")
    batch.add_argument("--store", required=True, help="folder of the run store")
    batch.add_argument("--run-id")
    batch.add_argument("--sample-rows", type=int, help="use only the first rows of each file")
    batch.add_argument("--clusters", type=int, default=10)
    batch.add_argument("--work-dir", help="shared folder for intermediate data; default: below the store")
    batch.set_defaults(job=_batch)

    publish = jobs.add_parser("publish", help="send incident rows as event messages")
    publish.add_argument("--crimes", required=True)
    publish.add_argument("--max-rows", type=int)
    publish.set_defaults(job=_publish)

    alerts = jobs.add_parser("alerts", help="run the alert stream")
    alerts.add_argument("--store", required=True)
    alerts.add_argument("--checkpoint", required=True)
    alerts.add_argument("--size", type=int, default=values.WINDOW_SECONDS)
    alerts.add_argument("--slide", type=int, default=values.SLIDE_SECONDS)
    alerts.add_argument("--threshold", type=int, default=values.THRESHOLD)
    alerts.add_argument("--minima", type=int, nargs=3, default=list(values.SEVERITY_MINIMA.values()))
    alerts.add_argument("--time-basis", choices=("event", "arrival"), default="event")
    alerts.add_argument("--late", default="1 hour", help="how far behind the newest event one may come and count; idle areas are forgotten after it")
    alerts.add_argument("--intake", type=int, default=1_000_000, help="most messages of a Kafka micro-batch")
    alerts.add_argument("--schema", help="columns of a file source, such as 'value string, timestamp timestamp'")
    alerts.add_argument("--raw-log", action="store_true", help="keep every accepted event, by day of intake")
    alerts.add_argument("--every", help="trigger interval, such as '10 seconds'; default: what is there, then end")
    alerts.set_defaults(job=_alerts)

    expire = jobs.add_parser("expire", help="drop raw events past their time to live")
    expire.add_argument("--store", required=True)
    expire.add_argument("--ttl", type=int, default=86400, help="seconds an event is kept after its intake")
    expire.set_defaults(job=_expire)

    for job in (batch, publish):
        job.add_argument("--input-format", choices=("csv", "parquet"), default="csv")
        job.add_argument("--single-line", action="store_true", help="no field holds a line break: one scan is enough")
    for job in (publish, alerts):
        job.add_argument("--format", default="kafka")
        job.add_argument("--path")
        job.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="source or sink option")

    return parser


def main() -> None:
    args = parser().parse_args()
    args.job(args)


if __name__ == "__main__":
    main()

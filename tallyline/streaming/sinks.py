"""Idempotent sinks for micro-batches, on plain file tables.

A table is a folder partitioned by day and batch. A batch is named by the id of the
streaming query, which lives in its checkpoint, and by its number. A micro-batch only ever writes
its own partitions, by overwrite, so a replay of it writes the same files again,
a query begun afresh does not touch what another one wrote, and nothing that is
already there is rewritten. A micro-batch lists and reads the folders of its own
days only, whatever the history. :meth:`BatchTable.fold` puts a closed day into one
folder. Where micro-batches span many days a table takes a folder per month instead
(``span``): each folder is made, renamed and listed on its own, however few its rows are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.hops import hop_counts
from tallyline.operators.keys import first_per_key
from tallyline.session import folder_names, path_exists, remove_path, state_width
from tallyline.streaming.alerts import alert_documents, alert_rows, anomaly_rows, count_rows

NEWEST_DAYS = 8
# What of a date is set to name the folder it belongs to.
SPANS: dict[str, dict[str, int]] = {"day": {}, "month": {"day": 1}, "year": {"month": 1, "day": 1}}
TASK_ROWS = 1_000_000
TAGS = "written_at timestamp, writer string, batch_id long, day date, batch string"


@dataclass(frozen=True)
class BatchTable:
    """A file table written batch by batch; ``day_of`` names a timestamp column.

    ``span`` (of :data:`SPANS`) tells how much time a folder holds. With a month or a year the
    tag ``day``, and what is said of days below, is the first day of it.
    The names in :data:`TAGS` belong to the table; rows must not use them.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    day_of: str
    fmt: str = "parquet"
    span: str = "day"

    def __post_init__(self) -> None:
        if self.span not in SPANS:
            raise ValueError(f"unknown span of a folder: {self.span}")

    def _day(self) -> Column:
        """The day that names a row's folder."""
        day = F.to_date(F.col(self.day_of))
        return day if self.span == "day" else F.trunc(day, self.span)

    def _sizes(self, rows: DataFrame) -> dict[str | None, int]:
        """How many rows each day has: a number per day of the batch reaches the driver."""
        return dict(rows.groupBy(self._day().cast("string").alias("day")).count().collect())

    def _gathered(self, tagged: DataFrame, sizes: dict[str | None, int]) -> DataFrame:
        """Few files per day, side by side: a day goes to one task, one of more than
        :data:`TASK_ROWS` rows to several, and the days of a batch to all cores. Making
        folders and files is what many small days cost, and AQE, which goes by bytes,
        would leave them to one task."""
        files = {day: -(-n // TASK_ROWS) for day, n in sizes.items()}
        cores = self.spark.sparkContext.defaultParallelism
        width = max(1, min(sum(files.values()), max(cores, sum(sizes.values()) // TASK_ROWS)))
        large = [F.lit(x) for day, n in files.items() if n > 1 for x in (day or "", n)]
        if not large:
            return tagged.repartition(width, "day")
        parts = F.coalesce(F.try_element_at(F.create_map(*large), F.coalesce(F.col("day").cast("string"), F.lit(""))), F.lit(1))
        return tagged.repartition(width, F.col("day"), F.pmod(F.xxhash64(*self.keys, self.day_of), parts))

    def _write(self, rows: DataFrame, batch_id: int, writer: str, sizes: dict[str | None, int] | None = None) -> None:
        """``sizes`` tells how many rows a day has at most, where that is known; else they are counted first."""
        taken = sorted(set(rows.columns) & {tag.split()[0] for tag in TAGS.split(", ")})
        if taken:
            raise ValueError(f"column names kept for the table's own use: {taken}")
        tagged = rows.withColumns(
            {
                "written_at": F.current_timestamp(),
                "writer": F.lit(writer),
                "batch_id": F.lit(batch_id).cast("long"),
                "day": self._day(),
                "batch": F.lit(f"{writer}-{batch_id}"),
            }
        )
        gathered = self._gathered(tagged, self._sizes(rows) if sizes is None else sizes)
        (
            gathered.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch")
            .format(self.fmt)
            .save(self.path)
        )

    def stored(self, like: DataFrame, days: Sequence[date | None] | None = None) -> DataFrame:
        """Rows with their tags, all ever written or those of some days; empty before the first.

        With ``days`` no other day's folder is listed.
        """
        schema = f"{_ddl(like)}, {TAGS}"
        if days is None:
            paths = [self.path] if path_exists(self.spark, self.path) else []
        else:
            folders = [self._folder(day) for day in days]
            paths = [p for p in folders if path_exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).format(self.fmt).load(paths)

    def _folder(self, day: date | None) -> str:
        return f"{self.path}/day={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"

    def days(self) -> list[date]:
        """The days there are, newest first: one listing of the table's folder, not of what is below."""
        return sorted((date.fromisoformat(name) for name in folder_names(self.spark, self.path, "day=") if name[:1].isdigit()), reverse=True)

    def newest(self, like: DataFrame, n: int) -> DataFrame:
        """:meth:`latest` over as many of the newest days as hold ``n`` rows, for pages
        whose order begins with the day's column. The newest days are counted by one
        aggregate, and twice as many by another only where they do not fill the page,
        so a page costs the same however long the history is."""
        days, taken = self.days(), NEWEST_DAYS
        while True:
            chosen = days[:taken]
            keys = F.count_distinct(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.keys)).alias("n")
            sizes = dict(self.stored(like, chosen).groupBy("day").agg(keys).collect()) if chosen else {}
            held = 0
            for number, day in enumerate(chosen, 1):
                held += sizes.get(day, 0)
                if held >= n:
                    return self.latest(like, chosen[:number])
            if taken >= len(days):
                return self.latest(like, chosen)
            taken *= 2

    def fold(self, like: DataFrame, day: date) -> None:
        """Put a closed day's last row per key and writer into one folder, then drop the others.

        The rows keep their tags, so they win and lose against later ones as before.
        A reader that meets both meets the same rows twice.
        """
        rows = self.stored(like, [day])
        best = rows.groupBy(*self.keys, "writer").agg(F.max_by(F.struct(*rows.columns), _order()).alias("row")).select("row.*")
        others = folder_names(self.spark, self._folder(day), "batch=")
        target = f"folded-{uuid.uuid4().hex}"
        path = f"{self._folder(day)}/batch={target}"
        best.drop("day", "batch").write.format(self.fmt).save(path)
        for name in others:
            remove_path(self.spark, f"{self._folder(day)}/batch={name}")

    def expire(self, cutoff: datetime) -> None:
        """Drop the rows whose ``day_of`` is before the cutoff (UTC): whole day folders without
        reading them, and of the cutoff's own day the batches that have older rows.

        A running writer is not disturbed: it only makes folders of newer batches. Of a
        batch with rows on both sides the newer ones are written to a folder of their
        own before the old folder goes, so no row to be kept is missing at any time; a reader
        between the two meets it twice, as after :meth:`fold`. A second run changes nothing.
        """
        edge = cutoff.date().replace(**SPANS[self.span])
        for day in self.days():
            if day < edge:
                remove_path(self.spark, self._folder(day))
        if not folder_names(self.spark, self._folder(edge), "batch="):
            return
        rows = self.spark.read.option("basePath", self.path).format(self.fmt).load(self._folder(edge))
        limit = F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
        ends = rows.groupBy("batch").agg(F.min(self.day_of).alias("low"), F.max(self.day_of).alias("high"))
        # As many rows as the day has micro-batches with something to drop.
        old = ends.where(F.col("low") < limit).select("batch", (F.col("high") >= limit).alias("both")).collect()
        both = [row["batch"] for row in old if row["both"]]
        if both:
            path = f"{self._folder(edge)}/batch=kept-{uuid.uuid4().hex}"
            kept = rows.where(F.col("batch").isin(both) & (F.col(self.day_of) >= limit))
            kept.drop("day", "batch").write.format(self.fmt).save(path)
        for row in old:
            remove_path(self.spark, f"{self._folder(edge)}/batch={row['batch']}")

    def upsert(self, rows: DataFrame, batch_id: int, writer: str) -> None:
        """Last write wins: the batch is appended, :meth:`latest` picks the winner."""
        self._write(rows, batch_id, writer)

    def latest(self, like: DataFrame, days: Sequence[date | None] | None = None) -> DataFrame:
        """The row written last, per key, of all days or some. Filters on ``day`` prune;
        the choice is an aggregate with a map-side part, not a window over each key.

        Within one query the number of the batch decides, whatever the clocks of its
        drivers said; between queries the one that wrote last.
        """
        rows = self.stored(like, days)
        rest = [c for c in like.columns if c not in self.keys]
        last = rows.groupBy("day", *self.keys, "writer").agg(
            F.max_by(F.struct(*rest), _order()).alias("row"), F.max("written_at").alias("written_at")
        )
        newest = last.groupBy("day", *self.keys).agg(F.max_by("row", F.struct("written_at", "writer")).alias("row"))
        return newest.select(*(F.col(c) if c in self.keys else F.col(f"row.{c}") for c in like.columns))

    def insert_absent(self, rows: DataFrame, batch_id: int, writer: str) -> DataFrame:
        """Append rows whose key is not stored yet; give back what this batch added.

        The stored keys are read for the days of this batch only; its days are all
        that reaches the driver. What an earlier try of this very batch left is not
        taken as stored.
        """
        once = first_per_key(rows, self.keys)
        sizes = self._sizes(once)
        days = [None if day is None else date.fromisoformat(day) for day in sizes]
        mine = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
        known = self.stored(rows, days).where(~mine)
        added = once.join(known.select(*self.keys), list(self.keys), "left_anti").select(*rows.columns)
        self._write(added, batch_id, writer, sizes)
        return self.stored(rows, days).where(F.col("batch") == f"{writer}-{batch_id}").select(*rows.columns)


def _order() -> Column:
    """What makes a later row of one writer."""
    return F.struct("batch_id", "written_at")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


@dataclass(frozen=True)
class AlertStore:
    """The three outputs of the speed layer below one folder. ``span`` is that of the tables
    by event time, see :class:`BatchTable`; what lies by the time of writing has a folder per day."""

    spark: SparkSession
    root: str
    span: str = "day"

    @property
    def counts(self) -> BatchTable:
        return BatchTable(
            self.spark, f"{self.root}/realtime_district_counts", ("district", "window_start", "window_end"), "window_end", span=self.span
        )

    @property
    def alerts(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/alerts", ("alert_id",), "window_end", span=self.span)

    @property
    def recent(self) -> BatchTable:
        """The alerts again, by the day they were written: the page of the newest ones reads the newest days only."""
        return BatchTable(self.spark, f"{self.root}/alerts_by_writing", ("alert_id",), "alert_timestamp")

    @property
    def documents(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/alert_logs", ("alert_id",), "window_end", "json", self.span)

    def save(self, anomalies: DataFrame, batch_id: int, writer: str, source: str = "stream") -> None:
        """Counts always; alerts and their documents only with a severity."""
        self.counts.upsert(count_rows(anomalies), batch_id, writer)
        raised = alert_rows(anomalies, source)
        if raised.isEmpty():  # most micro-batches raise nothing
            return
        added = self.alerts.insert_absent(raised, batch_id, writer)
        self.documents.upsert(alert_documents(added), batch_id, writer)
        self.recent.upsert(added, batch_id, writer)

    def page(self, like: DataFrame, n: int) -> DataFrame:
        """Alerts among which the ``n`` written last are, each once."""
        rows = self.recent.newest(like, n)
        rest = [c for c in like.columns if c != "alert_id"]
        last = rows.groupBy("alert_id").agg(F.max(F.struct("alert_timestamp", *(c for c in rest if c != "alert_timestamp"))).alias("row"))
        return last.select(*(F.col(c) if c == "alert_id" else F.col(f"row.{c}") for c in like.columns))


def start_alerts(
    emits: DataFrame,
    store: AlertStore,
    checkpoint: str,
    key: str = "key",
    minima: dict[str, int] | None = None,
    threshold: int = 25,
    mode: str = "append",
    trigger: dict | None = None,
    source: str = "stream",
) -> StreamingQuery:
    """Run the speed layer: emitted windows to counts, alerts and documents."""

    def save(batch: DataFrame, batch_id: int, writer: str) -> None:
        store.save(anomaly_rows(batch, key, minima, threshold), batch_id, writer, source)

    return start_batches(emits, save, checkpoint, mode, trigger)


def start_batches(
    rows: DataFrame,
    save: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    width: int | None = None,
) -> StreamingQuery:
    """A streaming query that hands each micro-batch, its number and the query id to ``save``.

    ``width`` is the number of partitions of keyed state; see :func:`session.state_width`.

    The micro-batch is first written beside the checkpoint, in one of two slots that
    take turns, and ``save`` gets it as read back by the session that defined the
    stream. A stateful stream runs without adaptive execution; what ``save`` does is
    a plain batch job again, and reads the result of the state step, not the step.
    """
    spark, schema = rows.sparkSession, rows.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        slot = f"{checkpoint.rstrip('/')}-batches/slot-{batch_id % 2}"
        batch.write.mode("overwrite").parquet(slot)
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        save(spark.read.schema(schema).parquet(slot), batch_id, query_id)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    with state_width(spark, width):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_raw_log(
    documents: DataFrame, path: str, checkpoint: str, columns: Sequence[str] = (), trigger: dict | None = None
) -> StreamingQuery:
    """Optional raw event log, one folder per day of intake and micro-batch: see :func:`raw_log`."""
    chosen = documents.select(*columns) if columns else documents
    return start_batches(chosen, raw_log(documents.sparkSession, path).upsert, checkpoint, "append", trigger)


def raw_log(spark: SparkSession, path: str) -> BatchTable:
    """The raw event log as a table; :meth:`BatchTable.expire` drops what is past its time to live."""
    return BatchTable(spark, path, ("event_id",), "ingested_at")


def start_late_split(
    marked: DataFrame,
    counts: BatchTable,
    late_path: str,
    checkpoint: str,
    key: str,
    time: str,
    size: int,
    slide: int,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window counts of the events on time, and the late ones beside them like refused messages.

    ``marked`` comes from :func:`windows.marked_late`. One query feeds both, so that each
    event is in one of them. A micro-batch adds its own counts per window as rows of
    ``counts`` (:func:`summed_parts` adds them up); late events go to ``late_path`` as JSON,
    in folders of the same span.
    """
    late_rows = BatchTable(marked.sparkSession, late_path, (), time, "json", counts.span)

    def save(batch: DataFrame, batch_id: int, writer: str) -> None:
        parts = hop_counts(batch.where(~F.col("late")), key, time, size, slide)
        counts.upsert(parts, batch_id, writer)
        late_rows.upsert(batch.where("late").drop("late"), batch_id, writer)

    return start_batches(marked, save, checkpoint, "append", trigger)


def summed_parts(counts: BatchTable, like: DataFrame, value: str = "event_count") -> DataFrame:
    """Counts per key, added up over the micro-batches that found some of them."""
    keys = [c for c in like.columns if c != value]
    return counts.stored(like).groupBy(*keys).agg(F.sum(value).alias(value))


def start_quarantine(rejects: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Refused messages as JSON lines."""
    writer = rejects.writeStream.format("json").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)

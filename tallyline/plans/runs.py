"""Run protocol: ledger, staged tables, publish, and the whole batch run.

A publish is one commit over all its tables. The rows of each table are written to a
fresh folder of their own, which no reader looks at yet; then a commit file that names
all these folders is renamed into place. Readers go by the commits: per table and run the
last commit that has it decides. A publish that ends anywhere before the rename
changes nothing for readers, and an older publish of the same run stays whole.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.values import new_run_id
from tallyline.operators.clusters import hotspots, valid_points
from tallyline.plans.contracts import CREATED, RESULT_TABLES, columns_of, conform
from tallyline.plans.correlations import correlations
from tallyline.plans.density import sex_offender_density
from tallyline.plans.incidents import area_violence, detail_counts, violence_stats
from tallyline.plans.outcomes import arrest_rates, case_tally
from tallyline.plans.trends import crime_trends
from tallyline.session import folder_names, materialise, path_exists, remove_path, write_whole
from tallyline.sources.cleaning import CLEANERS

# States of a run.
RUNNING, COMPLETED, FAILED = "running", "completed", "failed"

LEDGER_SCHEMA = "run_id string, job_name string, status string, seq int, at timestamp, message string"


@dataclass(frozen=True)
class RunStore:
    """Where the tables of all runs live: one folder per table, one partition per run."""

    spark: SparkSession
    root: str

    def _path(self, table: str, staged: bool) -> str:
        return f"{self.root}/{'staging' if staged else 'final'}/{table}"

    def _write(self, df: DataFrame, run_id: str, path: str) -> int:
        """Write the rows of one run to a folder; their count comes with the write."""
        if not re.fullmatch(r"[0-9A-Za-z_.-]+", run_id):
            raise ValueError(f"run id is not usable as a folder name: {run_id!r}")
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.drop("run_id").write.mode("overwrite").parquet(path)
        return int(seen.get["rows"])

    def stage(self, df: DataFrame, table: str, run_id: str) -> int:
        """Write a result to its staging table; the run's earlier rows there go."""
        return self._write(conform(df, table, run_id), run_id, f"{self._path(table, True)}/run_id={run_id}")

    def read(self, table: str, staged: bool = False) -> DataFrame:
        """All runs of a table; empty with the right columns before the first write."""
        schema = ", ".join(f"{n} {t}" for n, t in columns_of(table)) + f", {CREATED} timestamp, run_id string"
        path = self._path(table, staged)
        if staged:
            return conform(_read_or_empty(self.spark, path, schema), table)
        parts = [f"{path}/run_id={run}/part={part}" for run, part in sorted(self.published(table).items())]
        if not parts:
            return conform(self.spark.createDataFrame([], schema), table)
        reader = self.spark.read.schema(f"{schema}, part string").option("basePath", path)
        return conform(reader.parquet(*parts).drop("part"), table)

    def commits(self) -> DataFrame:
        """What every publish made visible: its number, tables, runs, folders and rows."""
        shape = "number long, run_id string, parts array<struct<table: string, part: string, rows: long>>"
        path = f"{self.root}/commits"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], "number long, run_id string, table string, part string, rows long")
        listed = self.spark.read.schema(shape).json(path)
        return listed.select("number", "run_id", F.inline("parts"))

    def published(self, table: str) -> dict[str, str]:
        """The folder that counts of each run of a table: one row per run reaches the driver."""
        mine = self.commits().where(F.col("table") == table)
        return dict(mine.groupBy("run_id").agg(F.max_by("part", F.struct("number", "part")).alias("part")).collect())

    def publish(self, run_id: str, tables: Iterable[str]) -> dict[str, int]:
        """Staging rows of the run replace its rows in the final tables, in all of them at once."""
        names = list(tables)
        for table in names:
            columns_of(table)
            if not path_exists(self.spark, f"{self._path(table, staged=True)}/run_id={run_id}"):
                raise ValueError(f"nothing is staged of {table} for run {run_id}")
        rows, part = {}, uuid.uuid4().hex
        try:
            for table in names:
                staged = self.read(table, staged=True).where(F.col("run_id") == run_id)
                rows[table] = self._write(staged, run_id, self._part(table, run_id, part))
            self._commit(run_id, part, rows)
        except Exception:
            for table in names:
                remove_path(self.spark, self._part(table, run_id, part))
            raise
        return rows

    def _part(self, table: str, run_id: str, part: str) -> str:
        return f"{self._path(table, staged=False)}/run_id={run_id}/part={part}"

    def _commit(self, run_id: str, part: str, rows: Mapping[str, int]) -> None:
        """Make the folders of a publish visible, all by one rename."""
        taken = [int(name.split("-")[0]) for name in folder_names(self.spark, f"{self.root}/commits", "") if name[:1].isdigit()]
        number = max(taken, default=0) + 1
        parts = [{"table": table, "part": part, "rows": n} for table, n in rows.items()]
        commit = {"number": number, "run_id": run_id, "parts": parts}
        write_whole(self.spark, f"{self.root}/commits/{number:010d}-{part}.json", json.dumps(commit))

    def drop_replaced(self) -> None:
        """Remove folders that a later publish of their run replaced, and what broken publishes left.

        For a time without readers of the replaced rows and without a running publish.
        """
        for table in {row["table"] for row in self.commits().select("table").distinct().collect()}:
            current = self.published(table)
            for run in folder_names(self.spark, self._path(table, False), "run_id="):
                for part in folder_names(self.spark, f"{self._path(table, False)}/run_id={run}", "part="):
                    if current.get(run) != part:
                        remove_path(self.spark, self._part(table, run, part))

    def export(self, table: str, run_id: str, fmt: str, **options: str) -> None:
        """Append a published run of a table to any other Spark sink, such as ``jdbc``."""
        rows = self.read(table).where(F.col("run_id") == run_id)
        rows.write.format(fmt).options(**options).mode("append").save()

    def mark(self, run_id: str, job_name: str, status: str, message: str = "") -> None:
        """Append one state of a run."""
        if status not in (RUNNING, COMPLETED, FAILED):
            raise ValueError(f"unknown status: {status}")
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(run_id).alias("run_id"),
            F.lit(job_name).alias("job_name"),
            F.lit(status).alias("status"),
            F.lit(0 if status == RUNNING else 1).alias("seq"),
            F.current_timestamp().alias("at"),
            F.lit(message).alias("message"),
        )
        row.write.mode("append").parquet(f"{self.root}/ledger")

    def ledger(self) -> DataFrame:
        """Every state ever appended."""
        return _read_or_empty(self.spark, f"{self.root}/ledger", LEDGER_SCHEMA)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def ledger_state(ledger: DataFrame) -> DataFrame:
    """Latest state per run: the batch status table."""
    order = F.struct("seq", "at", "status", "message")
    begun = F.min(F.when(F.col("status") == RUNNING, F.col("at")))
    ended = F.max(F.when(F.col("status") != RUNNING, F.col("at")))
    succeeded = F.max(F.when(F.col("status") == COMPLETED, F.col("at")))
    latest = ledger.groupBy("run_id", "job_name").agg(
        F.max(order).alias("state"),
        begun.alias("started_at"),
        ended.alias("finished_at"),
        succeeded.alias("last_successful_run"),
    )
    return latest.select(
        "run_id",
        "job_name",
        F.col("state.status").alias("status"),
        "started_at",
        "finished_at",
        "last_successful_run",
        F.col("state.message").alias("message"),
    )


def analyse(clean: Mapping[str, DataFrame], density: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The other result tables of one run, over the clean tables and the density rows.

    The tally of cases and outcomes is kept: one dedupe and one join of the two
    large tables serve the rates and the correlations. So are the counts of victims,
    which both the statistics and the correlations sum up further.
    """
    crimes = clean["crimes"]
    tally = materialise(case_tally(crimes, clean["arrests"]))
    detail = materialise(detail_counts(clean["violence"]))
    return {
        "crime_trends": crime_trends(crimes),
        "arrest_rates": arrest_rates(tally),
        "violence_stats": violence_stats(detail),
        "hotspots": hotspots(valid_points(crimes, F.col("latitude"), F.col("longitude")), k),
        "correlations": correlations(tally, area_violence(detail), density),
    }


def run_batch(
    store: RunStore,
    raw: Mapping[str, DataFrame],
    run_id: str | None = None,
    job_name: str = "batch-analytics",
    k: int = 10,
) -> str:
    """Ledger row, clean, analyse, stage all, publish all, ledger row.

    Any failure marks the run failed, and nothing of it is published. The clean
    incidents are read by four of the six analytics and are kept as Parquet in
    the store for that time; density is read back from staging for the
    correlations. Both go at the end, whatever it is. An id names one attempt: an
    id that has a state already is refused, so that no reader meets a completed
    run whose tables are being replaced.
    """
    run = run_id or new_run_id()
    if not store.ledger().where(F.col("run_id") == run).isEmpty():
        raise ValueError(f"run id is used already: {run}")
    store.mark(run, job_name, RUNNING, "run begun")
    kept = f"{store.root}/clean/crimes/run_id={run}"
    try:
        clean = {name: CLEANERS[name](raw[name]) for name in CLEANERS}
        clean["crimes"].write.mode("overwrite").parquet(kept)
        clean["crimes"] = store.spark.read.parquet(kept)

        density = sex_offender_density(clean["sex_offenders"], clean["police_stations"], clean["crimes"])
        store.stage(density, "sex_offender_density", run)
        staged = store.read("sex_offender_density", staged=True).where(F.col("run_id") == run)
        for table, result in analyse(clean, staged.drop("run_id"), k).items():
            store.stage(result, table, run)
        rows = store.publish(run, RESULT_TABLES)
    except Exception as problem:
        store.mark(run, job_name, FAILED, str(problem))
        raise
    finally:
        remove_path(store.spark, kept)
        for table in RESULT_TABLES:
            remove_path(store.spark, f"{store._path(table, staged=True)}/run_id={run}")
    listed = ", ".join(f"{table}={count}" for table, count in rows.items())
    store.mark(run, job_name, COMPLETED, f"published {listed}")
    return run


def row_counts(store: RunStore, run_id: str) -> DataFrame:
    """Published rows per table of one run; a table without rows shows zero."""
    counts = (
        store.read(table).where(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), "row_count")
        for table in RESULT_TABLES
    )
    return reduce(DataFrame.unionByName, counts)

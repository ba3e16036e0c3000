"""What the operators share: tables, stored intermediates, row keys."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import shared_dir

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = 2**63 - 1

_SCRATCH: dict[str, str] = {}


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let Arrow batches to Python workers have at most so many bytes (or one row), where the session allows more.

    Batches are made in each running task on both sides, several copies of them, so with
    long texts their size decides the memory that an executor needs.
    """
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", spark.conf.get(BATCH_SETTING).strip().lower()).groups()
    if int(number) * _UNITS.get(unit, 1 << 40) > most:
        spark.conf.set(BATCH_SETTING, str(most))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, to be read by operators that hand texts to Python in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(context._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    there, system = _hadoop(spark, path)
    system.delete(there, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; the application's ones go when it ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{shared_dir(spark).rstrip('/')}/llm-{app}-{uuid.uuid4().hex}"
        atexit.register(_sweep, spark, _SCRATCH[app])
    return f"{_SCRATCH[app]}/{label}-{uuid.uuid4().hex}"


def _sweep(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001 - the session may have ended first; nothing is lost then
        pass


class Stash:
    """Frames written as Parquet in the shared folder and read back.

    A written table survives lost executors, costs little disk, and has no
    partitioning that would keep Spark from splitting a skewed join later.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def put(self, frame: DataFrame, label: str) -> DataFrame:
        path = scratch(self.spark, label)
        frame.write.parquet(path)
        back = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Remove frames that no result reads any more."""
        for frame in frames:
            path = self.paths.pop(id(frame), None)
            if path:
                remove(self.spark, path)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame does not have, whatever it has."""
    taken = {c.lower() for c in frame.columns}
    made = []
    for name in names:
        candidate = f"llm_{name}"
        while candidate.lower() in taken:
            candidate += "_"
        taken.add(candidate.lower())
        made.append(candidate)
    return made


def text_key(text: Column | str = "text") -> Column:
    """Tells the texts under one doc_id apart; NULL texts get a key of their own."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(column)


def id_key(column: Column | str = "doc_id") -> Column:
    """The id as a number that is never NULL; rows without an id come last."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def id_of(key: Column | str) -> Column:
    """The id back from :func:`id_key`."""
    column = F.col(key) if isinstance(key, str) else key
    return F.when(column != NO_ID, column)


def learnable(column: str, modulus: int, held_out: int) -> Column:
    """False for the rows that a contract holds out of training."""
    return ~is_held_out(column, modulus, held_out)


def is_held_out(column: str, modulus: int, held_out: int) -> Column:
    """crc32 of the id as text leaves the given remainder; a row without an id does not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == held_out, F.lit(False))


def bounded(frame: DataFrame, rows: int, total: int, *key: str) -> DataFrame:
    """About ``rows`` of ``total`` rows by hash of the key, never more.

    Hashes are cut off before the limit, so what all tasks send is bounded too.
    """
    share = min(1.0, 1.2 * rows / max(total, 1))
    lucky = F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    return frame.where(lucky).orderBy(F.xxhash64(*key), *key).limit(rows)

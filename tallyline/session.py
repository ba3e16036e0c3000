"""Session set-up and the shared folder for intermediate data."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_SETTING = "spark.sql.shuffle.partitions"
LOCAL_MASTER = re.compile(r"local(\[[^\]]*\])?")

# What a large cluster job starts from. The first shuffle width is generous and AQE
# merges small partitions to the advised size; skewed joins are split; keyed stream
# state lives outside the heap.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Files are split alike whatever number of cores a job finds.
    "spark.sql.files.minPartitionNum": "1000",
    # Rows with long texts go to Python workers in batches of bounded bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "tallyline", master: str | None = None, cluster: bool = False, **conf: str
) -> SparkSession:
    """Create (or get) a session with the settings the operators rely on.

    ``cluster`` adds :data:`CLUSTER_CONF`; keyword settings write ``__`` for a dot.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    given = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in {**(CLUSTER_CONF if cluster else {}), **given}.items():
        builder = builder.config(name, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without a zone are read as UTC everywhere in this library."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and
    the driver is all there is (tests, a laptop) a local folder is made, once per
    application; on a cluster that is refused, as each executor would write to its
    own disk.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not named and not LOCAL_MASTER.fullmatch(context.master):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyline-"))
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder of that name, on whatever file system it names?"""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(context._jsc.hadoopConfiguration()).exists(there)


def folder_names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names right below a folder; none where it is not there."""
    if not path_exists(spark, path):
        return []
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(there)
    names = (entry.getPath().getName() for entry in found)
    return [name[len(prefix) :] for name in names if name.startswith(prefix)]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library's own making, if it is there."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(context._jsc.hadoopConfiguration()).delete(there, True)


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that is there whole or not at all: under another name first, then renamed."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    there = hadoop.Path(path)
    system = there.getFileSystem(context._jsc.hadoopConfiguration())
    made = hadoop.Path(there.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = system.create(made)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(there) or not system.rename(made, there):
        system.delete(made, False)
        raise FileExistsError(path)


def set_file_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set when a file was last changed, which orders the files of a stream."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(context._jsc.hadoopConfiguration()).setTimes(there, millis, -1)


@contextmanager
def state_width(spark: SparkSession, width: int | None = None) -> Iterator[None]:
    """Streams begun in here deal their keyed state over ``width`` partitions.

    Every micro-batch opens and commits each partition of the state, however little is
    in it, so by default there are as many as the cluster has cores, and never more than
    the session's shuffles have. Spark copies the setting when a stream begins and keeps
    it in the checkpoint: a stream begun before goes on with what it has.
    """
    before = spark.conf.get(SHUFFLE_SETTING)
    spark.conf.set(SHUFFLE_SETTING, str(width or min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_SETTING, before)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: evaluated once, survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

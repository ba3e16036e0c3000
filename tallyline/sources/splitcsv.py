"""Large CSV files with line breaks in quoted fields, read by many tasks.

Whether a line begins a record depends on all quotes before it. A stretch of a file can
only be entered outside or inside a quoted field, so each split of the text scan is
summed up as where it ends for either way to enter it (a function of two states). The
functions of a file's splits are put together by a prefix over (file, start of split),
which tells how each split is really entered. Then every split glues its lines to
records by itself, records that cross splits are put together from their parts, and
``from_csv`` reads each record under the schema. Where the look through finds a record on
every line, Spark's own scan by lines reads the files instead, only the columns asked for.

The text is scanned twice by Python helpers over Arrow batches; where records cross
splits a third scan picks their parts out of the splits concerned. Nothing is shuffled
but a row per split and the crossing records. What reaches the driver is one entry per
split, as many as the scan has tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.session import materialise

# The helpers travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, DELIMITER = '"', ","
OUTSIDE = -1

# How a split is left if entered outside and inside, and whether a record begins in it either way;
# ``plain`` if each of its lines, entered outside, is a record that a scan by lines reads alike.
EFFECTS = "path string, start long, out_end int, in_end int, out_begins boolean, in_begins boolean, plain boolean"

# Between any two commas is an even number of quotes: such a line is left as it is entered, outside or inside.
EVEN = r'^(?:[^"]|"[^",]*")*$'
# What a scan by lines reads in its own way: lines of white space only, and other ends of lines.
UNLIKE = r"\r|^[\x00-\x20]+$"


def leaves_inside(line: str, inside: bool) -> bool:
    """Is the end of a line inside a quoted field, if its begin is (or is not)?

    A field is quoted if a quote is its first character; inside it a quote is doubled.
    Quotes elsewhere in an unquoted field are plain characters.
    """
    if QUOTE not in line:
        return inside
    for piece in line.split(DELIMITER):
        if inside or piece[:1] == QUOTE:
            inside ^= piece.count(QUOTE) % 2 == 1
    return inside


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array, pa.Array]]:
    """Stretches of lines of one split, in order: file, start of the split, lines, and which are :data:`EVEN`."""
    for batch in batches:
        starts, paths, lines = batch.column("start"), batch.column("path"), batch.column("value")
        at = 0
        while at < batch.num_rows:
            here = pc.and_(pc.equal(starts, starts[at]), pc.equal(paths, paths[at])).slice(at)
            size = pc.index(here, False).as_py()
            size = batch.num_rows - at if size < 0 else size
            stretch = lines.slice(at, size)
            yield paths[at].as_py(), starts[at].as_py(), stretch, pc.match_substring_regex(stretch, EVEN)
            at += size


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split; see :data:`EFFECTS`."""
    done: list[tuple] = []
    key, ends, begins, plain = None, [False, True], [False, False], True
    for path, start, lines, even in _lines(batches):
        if (path, start) != key:
            if key:
                done.append((*key, *map(int, ends), *begins, plain))
            key, ends, begins = (path, start), [False, True], [False, False]
            plain = start > 0 or lines[0].as_py() != ""  # the header is the first line
        begins = [begun or not end for begun, end in zip(begins, ends, strict=True)]
        odd = np.flatnonzero(~even.to_numpy(zero_copy_only=False))
        plain = plain and not len(odd) and not pc.any(pc.match_substring_regex(lines, UNLIKE)).as_py()
        for at, line in zip(odd, lines.take(pa.array(odd)).to_pylist(), strict=True):
            ends = [leaves_inside(line, end) for end in ends]
            if at + 1 < len(lines):  # the next line begins as this one ends
                begins = [begun or not end for begun, end in zip(begins, ends, strict=True)]
    if key:
        done.append((*key, *map(int, ends), *begins, plain))
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_()]
    columns = list(zip(*done, strict=True)) if done else [[]] * len(kinds)
    names = [field.split()[0] for field in EFFECTS.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def entries(effects: DataFrame) -> DataFrame:
    """``(path, start, owner)``: the split where the record begins that a split is entered in,
    or :data:`OUTSIDE` where it is entered between records.

    A running composition of functions of two states: the last constant one decides, and
    each swap after it turns the state over.
    """
    order = Window.partitionBy("path").orderBy("start")
    swaps = F.sum(F.when((F.col("out_end") == 1) & (F.col("in_end") == 0), 1).otherwise(0)).over(order)
    counted = effects.withColumn("swaps", swaps)
    fixed = F.when(F.col("out_end") == F.col("in_end"), F.struct(F.col("out_end").alias("state"), "swaps"))
    marked = counted.withColumn("fixed", F.last(fixed, ignorenulls=True).over(order))
    since = F.col("swaps") - F.coalesce(F.col("fixed.swaps"), F.lit(0))
    left = marked.withColumn("exit", (F.coalesce(F.col("fixed.state"), F.lit(0)) + since) % 2)
    entered = left.withColumn("entry", F.coalesce(F.lag("exit").over(order), F.lit(0)))
    begins = F.when(F.col("entry") == 1, F.col("in_begins")).otherwise(F.col("out_begins"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(begins, F.col("start")), ignorenulls=True).over(before)
    return entered.select("path", "start", F.when(F.col("entry") == 1, owner).otherwise(F.lit(OUTSIDE)).alias("owner"))


def _records(layout: dict[str, dict[int, int]], parts: bool):
    """The whole records of each split; with ``parts`` what is left of those that cross splits.

    A part names the split its record begins in (``owner``), the split it lies in
    (``at``), and whether it belongs to the header.
    """

    def entered(path: str, start: int) -> int:
        owner = layout.get(path, {}).get(start)
        if owner is None:
            raise RuntimeError(
                "the files are split otherwise than when they were looked through; "
                "set spark.sql.files.minPartitionNum where the number of cores changes"
            )
        return owner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_lines, owner, inside, header = None, [], OUTSIDE, False, False

        def part() -> pa.RecordBatch:
            rows = [[key[0]], [key[1] if owner == OUTSIDE else owner], [key[1]], [header], ["\n".join(open_lines)]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["path", "owner", "at", "header", "record"])

        for path, start, lines, even in _lines(batches):
            if (path, start) != key:
                if open_lines and parts:
                    yield part()
                key, open_lines, owner = (path, start), [], entered(path, start)
                inside, header = owner != OUTSIDE, start == 0
            made: list[str] = []
            if not inside and pc.all(even).as_py():
                whole, header = lines.slice(1) if header else lines, False
                if len(whole) and not parts:
                    yield pa.RecordBatch.from_arrays([whole.cast(pa.string())], names=["record"])
            else:
                for line, same in zip(lines.to_pylist(), even.to_pylist(), strict=True):
                    open_lines.append(line)
                    inside = inside if same else leaves_inside(line, inside)
                    if not inside:
                        if owner != OUTSIDE:  # the end of a record that an earlier split began
                            if parts:
                                yield part()
                        elif not header:
                            made.append("\n".join(open_lines))
                        open_lines, owner, header = [], OUTSIDE, False
            if made and not parts:
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["record"])
        if open_lines and parts:
            yield part()

    return run


def scan_split(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of CSV files with a header under a fixed schema, large files by many tasks.

    The same rows as a ``multiLine`` scan in PERMISSIVE mode with ``"`` as the escape.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    effects = materialise(placed.mapInArrow(_effects, EFFECTS))
    options = {"mode": "PERMISSIVE", "escape": '"'}
    if effects.agg(F.coalesce(F.bool_and("plain"), F.lit(True)).alias("plain")).first()["plain"]:
        return spark.read.schema(schema).options(header=True, lineSep="\n", **options).csv(path)
    layout: dict[str, dict[int, int]] = {}
    for row in entries(effects).toLocalIterator():
        layout.setdefault(row["path"], {})[row["start"]] = row["owner"]
    records = placed.mapInArrow(_records(layout, parts=False), "record string")
    crossing = {start for starts in layout.values() for pair in starts.items() if pair[1] != OUTSIDE for start in pair}
    if crossing:
        some = placed.where(F.col("start").isin(sorted(crossing)))
        parts = some.mapInArrow(_records(layout, parts=True), "path string, owner long, at long, header boolean, record string")
        glued = parts.groupBy("path", "owner").agg(
            F.sort_array(F.collect_list(F.struct("at", "record"))).alias("pieces"), F.max("header").alias("header")
        )
        whole = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record")
        records = records.unionByName(glued.where(~F.col("header")).select(whole))
    ended = F.regexp_replace("record", "\r$", "")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("record", fields, {**options, "multiLine": "true"}).alias("row")
    parsed = records.select(ended.alias("record")).where(F.col("record") != "").select(row)
    return parsed.select(*(F.col("row")[f.name].alias(f.name) for f in schema.fields))

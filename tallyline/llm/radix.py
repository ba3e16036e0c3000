"""Distributed LSD radix sort: positions of rows in the order of composite integer keys.

The least significant key comes first; each pass is a stable counting sort by one digit
of one key. Rows lie in blocks of consecutive positions. A pass counts the digits of
each block, prefix sums over (digit, block) give the place where each block's rows with
a digit begin, and each block, by itself, works out where its rows go. So a pass
shuffles each row once, a task holds one block, and a key that all rows share is no
hot spot: blocks have a bounded number of rows whatever the keys are. Every pass is
written to the shared folder and read back, which makes it repeatable after a loss.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Stash

BLOCK_BITS = 13
DIGIT_BITS = 11


@dataclass(frozen=True)
class Digit:
    """Some bits of one key, counted from its least (or greatest, if descending) value."""

    column: str
    base: int
    descending: bool
    shift: int
    mask: int

    def of(self, values: np.ndarray) -> np.ndarray:
        """The digit of each value; differences of 64-bit values wrap to what they are."""
        values, base = values.astype(np.int64).view(np.uint64), np.int64(self.base).view(np.uint64)
        above = base - values if self.descending else values - base
        return ((above >> np.uint64(self.shift)) & np.uint64(self.mask)).astype(np.int32)


def digits(keys: list[tuple[str, int, int, bool]], most: int = DIGIT_BITS) -> list[Digit]:
    """Digits of (column, least, greatest, descending), the most significant key first;
    a key's bits are dealt over as few digits as ``most`` allows, evenly."""
    made = []
    for column, least, greatest, descending in reversed(keys):
        bits = (greatest - least).bit_length()
        passes = -(-bits // most)
        for k in range(passes):
            low, high = bits * k // passes, bits * (k + 1) // passes
            made.append(Digit(column, greatest if descending else least, descending, low, (1 << (high - low)) - 1))
    return made


def _tagged(table: pa.Table, names: list[str], at: np.ndarray, digit: Digit | None) -> pa.Table:
    """The rows with their positions, blocks and next digits."""
    next_digit = digit.of(table.column(digit.column).to_numpy()) if digit else np.zeros(len(at), np.int32)
    arrays = [table.column(n) for n in names]
    return pa.table([*arrays, pa.array(at), pa.array(at >> BLOCK_BITS), pa.array(next_digit)], names=[*names, "at", "block", "digit"])


def _first(names: list[str], digit: Digit | None):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield from _tagged(table, names, table.column("at").to_numpy(), digit).to_batches()

    return run


def _scatter(names: list[str], digit: Digit | None):
    """Where the rows of one block go, from where its digits begin."""

    def run(rows: pa.Table, begins: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _tagged(rows, names, np.zeros(0, np.int64), digit)
        order = np.argsort(rows.column("at").to_numpy(), kind="stable")
        found = rows.column("digit").to_numpy()[order]
        stable = np.argsort(found, kind="stable")
        counts = np.bincount(found)
        place = np.zeros(len(counts), np.int64)
        place[begins.column("of_digit").to_numpy()] = begins.column("begin").to_numpy()
        within = np.arange(len(found)) - (np.cumsum(counts) - counts)[found[stable]]
        at = np.empty(len(found), np.int64)
        at[order[stable]] = place[found[stable]] + within
        return _tagged(rows, names, at, digit)

    return run


def _begins(rows: DataFrame) -> DataFrame:
    """Global prefix offsets: where each block's rows with each digit begin."""
    digit, block = F.col("digit").alias("of_digit"), F.col("block").alias("of_block")
    counts = rows.groupBy(block, digit).agg(F.count(F.lit(1)).alias("n"))
    # One row per digit value, 2 ** DIGIT_BITS at most.
    totals = counts.groupBy("of_digit").agg(F.sum("n").alias("n"))
    below = totals.select("of_digit", (F.sum("n").over(Window.orderBy("of_digit")) - F.col("n")).alias("below"))
    earlier = F.sum("n").over(Window.partitionBy("of_digit").orderBy("of_block")) - F.col("n")
    return counts.join(F.broadcast(below), "of_digit").select("of_block", "of_digit", (F.col("below") + earlier).alias("begin"))


def positions(rows: DataFrame, keys: list[tuple[str, bool]], stash: Stash) -> DataFrame:
    """The rows with ``at``: 0, 1, 2... in the order of the keys (column, descending).

    Keys are integer columns without NULL, the most significant first; rows equal in all
    of them keep an arbitrary order. The result is stored.
    """
    taken = {"at", "block", "digit"} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"column names kept for the sort: {sorted(taken)}")
    names = rows.columns
    rows = stash.put(rows.withColumn("at", F.monotonically_increasing_id()), "radix-in")
    ends = rows.agg(*(f(c) for c, _ in keys for f in (F.min, F.max))).first()
    if ends[0] is None:
        return rows.withColumn("at", F.lit(0).cast("long"))
    passes = digits([(c, ends[2 * k], ends[2 * k + 1], down) for k, (c, down) in enumerate(keys)])
    # With all keys equal one pass is left, which makes the positions dense.
    passes = passes or [Digit(keys[0][0], ends[0], False, 0, 0)]
    shape = T.StructType(
        [*rows.drop("at").schema.fields, T.StructField("at", T.LongType()), T.StructField("block", T.LongType()), T.StructField("digit", T.IntegerType())]
    )
    placed = stash.put(rows.mapInArrow(_first(names, passes[0]), shape), "radix-0")
    stash.drop(rows)
    for k in range(len(passes)):
        coming = passes[k + 1] if k + 1 < len(passes) else None
        moved = placed.groupBy("block").cogroup(_begins(placed).groupBy("of_block")).applyInArrow(_scatter(names, coming), shape)
        done = stash.put(moved, f"radix-{k + 1}")
        stash.drop(placed)
        placed = done
    return placed.drop("block", "digit")

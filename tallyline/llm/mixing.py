"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear between
knots. Its integral, scaled to the source's target, is the demand for words up to a
time. A source's documents stand in a fixed order (by the MD5 of their id); the words
before a document are its place in the source's supply, and the time at which the
demand reaches that place is the document's training position. Supply beyond the first
reading is a second reading in the same order, so a document is read at most twice.
The document at the edge of a target is taken in part, so taken words meet the target
to the word. ``in_order`` range-sorts by position.

Targets: the total is 150 % of all words, dealt out by weight; a target ends at twice
its source's words, and what is over is dealt again by weight until none is above.
Sorted by room per weight that is one pass of running sums over a row per source.

A source with a third of all rows is split: running sums are made in pieces of about
``PIECE_ROWS`` documents (by hash), over pieces, and put together.

Defined results: NULL text and text without words have size 0 and take 0; a NULL source
is a source, last in order; rows without an id are ordered by their text key; equal
rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import WORD, Stash, fresh, id_key, id_of

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
READINGS = 2.0
PIECE_ROWS = 200
# Schedules by weight: heavy sources fade, light ones grow, the middle stays. (time, weight) knots.
SCHEDULES = {5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 1: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, readings: float = READINGS) -> DataFrame:
    """``(source, weight, source_size, target)`` from ``(source, size)``; a row per source."""
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights) + 1
    room = F.col("source_size") * F.lit(readings)
    weighed = every.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int"))).withColumn(
        "room", room
    )
    filled = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(total) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    level = weighed.withColumn("level", left / F.sum("weight").over(after))
    full = F.col("level") * F.col("weight") >= F.col("room")
    # Rows come by room per weight, so the full ones stand first; the first other row's level holds for all after it.
    open_level = F.min(F.when(~full, F.struct(F.col("room") / F.col("weight"), F.col("level").alias("level")))).over(everything)
    return level.select(
        "source", "weight", "source_size", F.when(full, F.col("room")).otherwise(F.col("weight") * open_level["level"]).alias("target")
    )


def _area(knots: Sequence[tuple[float, float]]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which a schedule has given out a share (0..1) of its integral."""
    area, done = _area(knots), 0.0
    steps = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        here = (t1 - t0) * (w0 + w1) / 2 / area
        rest = (share - F.lit(done)) * F.lit(area)
        slope = (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = rest, solved without cancellation.
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        steps.append((done + here, F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root)))
        done += here
    chosen = steps[-1][1]
    for end, when in reversed(steps[:-1]):
        chosen = F.when(share <= F.lit(end), when).otherwise(chosen)
    return F.least(chosen, F.lit(1.0))


def _position_by_weight(share: Column, schedules: dict[int, Sequence[tuple[float, float]]]) -> Column:
    chosen = F.lit(None).cast("double")
    for weight, knots in schedules.items():
        chosen = F.when(F.col("weight") == weight, position(share, knots)).otherwise(chosen)
    return chosen


def _row_key(text: str, source: str) -> Column:
    return F.xxhash64(F.col(text), F.lit(1), F.col(source))


def plan(
    docs: DataFrame,
    stash: Stash,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    piece_rows: int = PIECE_ROWS,
    schedules: dict[int, Sequence[tuple[float, float]]] = SCHEDULES,
) -> DataFrame:
    """One row per document row: size, target of its source, words taken, positions of both readings.

    Columns ``id`` (the id key), ``th, source, size, source_size, target, taken, first, second,
    first_position, second_position``; ``first`` and ``second`` are the words that a
    reading takes, positions are NULL where it takes none.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = stash.put(
        docs.select(
            id_key(id_col).alias("id"),
            _row_key(text, source).alias("th"),
            F.col(source).alias("source"),
            size.alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("turn"),
        ),
        "sizes",
    )
    goal = stash.put(targets(rows), "targets")
    pieces = max(1, rows.count() // piece_rows)
    # The piece comes from the leading hex digits, so pieces are stretches of the order.
    digits = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    cut = rows.withColumn("piece", F.floor(digits * F.lit(pieces) / F.lit(2**32)).cast("long"))
    # Stored, so that each piece is summed up before a source's pieces meet in one task.
    sums = stash.put(cut.groupBy("source", "piece").agg(F.sum("size").alias("words")), "sums")
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of"), F.col("piece").alias("at"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    offsets = stash.put(
        offsets.join(goal, offsets["of"].eqNullSafe(goal["source"])).select("of", "at", "offset", "weight", "source_size", "target"),
        "offsets",
    )
    inside = Window.partitionBy("source", "piece").orderBy("turn", "th", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(offsets, placed["source"].eqNullSafe(offsets["of"]) & (placed["piece"] == offsets["at"]))
    start = F.col("before") + F.col("offset")
    words = F.round("target").cast("long")
    take = lambda begin: F.greatest(F.lit(0), F.least(F.col("size"), words - begin)).cast("long")
    read = joined.withColumn("start", start).withColumns(
        {"first": take(F.col("start")), "second": take(F.col("start") + F.col("source_size"))}
    )
    share = lambda begin: F.try_divide(begin, F.col("target"))
    at = lambda taken, begin: F.when(F.col(taken) > 0, _position_by_weight(share(begin), schedules))
    return read.select(
        "id",
        "th",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("first") + F.col("second")).alias("taken"),
        "first",
        "second",
        at("first", F.col("start")).alias("first_position"),
        at("second", F.col("start") + F.col("source_size")).alias("second_position"),
    )


def by_position(read: DataFrame) -> DataFrame:
    """The rows of a stored :func:`plan`, range-sorted by the positions of their readings; those never read come last.

    The key ends with the row's own, so the many rows without a position are spread over tasks too.
    """
    return read.orderBy(F.col("first_position").asc_nulls_last(), F.col("second_position").asc_nulls_last(), "id", "th")


def in_order(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", with_position: bool = False
) -> DataFrame:
    """The mix itself: document rows once per reading, range-sorted by training position.

    A document taken in part has its first words only, one blank between them, and ``n_chars``, where the table has it, is counted anew.
    """
    stash = Stash(docs.sparkSession)
    key, th, many, place, f_id, f_th, size, readings, one = fresh(
        docs, "id", "th", "many", "position", "f_id", "f_th", "size", "readings", "one"
    )
    read = stash.put(plan(docs, stash, text, id_col, source), "readings")
    both = F.explode(
        F.array(
            F.struct(F.col("first_position").alias("position"), F.col("first").alias("taken")),
            F.struct(F.col("second_position").alias("position"), F.col("second").alias("taken")),
        )
    )
    taken = read.select("id", "th", "size", both.alias("r")).where("r.taken > 0")
    # Rows that are equal in id, text and source are one group here: its first row gets all the group's readings.
    found = taken.groupBy("id", "th", "size").agg(F.sort_array(F.collect_list("r")).alias("readings"))
    found = found.select("id", "th", "size", "readings").toDF(f_id, f_th, size, readings)
    marked = docs.withColumns({key: id_key(id_col), th: _row_key(text, source)})
    joined = marked.join(found, (F.col(key) == F.col(f_id)) & (F.col(th) == F.col(f_th)))
    alike = Window.partitionBy(key, th).orderBy(key, th)
    once = joined.withColumn(many, F.row_number().over(alike)).where(F.col(many) == 1)
    each = once.withColumn(one, F.explode(readings))
    part = F.col(one)["taken"] < F.col(size)
    words = F.regexp_extract_all(F.col(text), F.lit("(" + WORD + ")"), F.lit(1))
    shortened = F.array_join(F.slice(words, 1, F.greatest(F.col(one)["taken"], F.lit(1)).cast("int")), " ")
    new_text = F.when(part, shortened).otherwise(F.col(text))
    each = each.withColumn(place, F.col(one)["position"])
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(new_text.alias(c))
        elif c == "n_chars":
            columns.append(F.when(part, F.length(shortened)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(c))
    ordered = each.select(*columns, F.col(place)).orderBy(place, id_col)
    return ordered if with_position else ordered.drop(place)

"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are collapsed to distinct ones first. The index has two parts. Its upper
part is dealt out by Spark: with ``r`` differing bits allowed, two fingerprints agree
in at least one of ``r + 1`` blocks, so each fingerprint is filed once per block under
the pattern of that block; the block is rotated to the top, which makes everything
under one pattern a contiguous run in Gray order. The lower part is built in the task
that holds a run: the run is sorted by Gray rank, neighbours form leaves, and each node
keeps the bits that all below it share (a mask and a pattern). Pairs of nodes are walked
from the top; the differences in the bits shared so far add up, and a pair of groups
goes as a whole once they exceed ``r``.

A pattern with very many fingerprints is refined by blocks of its remaining bits
(exact for the same reason), and what is still large is cut into pieces whose pairs are
separate units of work, so no task holds an unbounded run. Units emit links that
span what they found connected, never all pairs.

Defined results: NULL or blank text has fingerprint zero and links like any other;
rows without an id link too, but never name a component unless all ids in it are NULL
(then ``component_id`` is NULL); equal ids, equal rows and other columns do not matter;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Stash, fresh, id_key, id_of, text_key
from tallyline.llm.components import components
from tallyline.llm.forest import absorb

SEED = 42
SHINGLE = 3
DISTANCE = 3
LEAF = 16
FANOUT = 8
UNIT_ROWS = 512
REFINE_OVER = 128 * UNIT_ROWS
BLOCK = 1 << 16


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is set where it is in over half the shingle hashes."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: len(words) - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), BLOCK):
        spans = zip(first[at : at + BLOCK].tolist(), last[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    made = [fingerprint_of(t.as_buffer().to_pybytes() if t.is_valid else None) for t in texts]
    return pa.array(np.array(made, np.uint64).view(np.int64))


def fingerprint(text: Column | str) -> Column:
    """The fingerprint as a signed long."""
    return _fingerprints(text)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each pattern in the reflected Gray sequence."""
    rank = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) per node, leaves first: the bits all below a node share, and their values."""
    levels = []
    every, some, width = prints, prints, LEAF
    while True:
        starts = np.arange(0, len(every), width)
        every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
        mask = ~(every ^ some)
        levels.append((mask, every & mask))
        if len(every) <= FANOUT:
            return levels
        width = FANOUT


def _children(i: np.ndarray, j: np.ndarray, width: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs one level down, unordered pairs once, with the row of the parent pair."""
    steps = np.arange(width)
    shape = (len(i), width, width)
    a = np.broadcast_to((i[:, None] * width + steps)[:, :, None], shape).reshape(-1)
    b = np.broadcast_to((j[:, None] * width + steps)[:, None, :], shape).reshape(-1)
    parent = np.repeat(np.arange(len(i)), width * width)
    keep = (a < total) & (b < total) & (a <= b)
    return a[keep], b[keep], parent[keep]


def join_run(prints: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Label (smallest row joined to) for each of a run's fingerprints, by a walk down the index."""
    order = np.argsort(gray_rank(prints), kind="stable")
    sorted_prints = prints[order]
    labels = np.arange(len(prints))
    levels = _levels(sorted_prints)
    top = len(levels) - 1
    nodes = len(levels[top][0])
    i, j = np.triu_indices(nodes)
    shared, gone = np.zeros(len(i), np.uint64), np.zeros(len(i), np.int64)
    stack = [(top, i, j, shared, gone)]
    while stack:
        level, i, j, shared, gone = stack.pop()
        if len(i) > 2048:
            half = len(i) // 2
            stack += [(level, *(x[half:] for x in (i, j, shared, gone))), (level, *(x[:half] for x in (i, j, shared, gone)))]
            continue
        mask, pattern = levels[level]
        common = mask[i] & mask[j]
        gone = gone + np.bitwise_count((pattern[i] ^ pattern[j]) & common & ~shared)
        near = gone <= distance
        i, j, shared, gone = i[near], j[near], common[near], gone[near]
        if level:
            a, b, parent = _children(i, j, FANOUT, len(levels[level - 1][0]))
            if len(a):
                stack.append((level - 1, a, b, shared[parent], gone[parent]))
            continue
        a, b, _ = _children(i, j, LEAF, len(prints))
        open_pairs = (a != b) & (labels[order[a]] != labels[order[b]])
        a, b = a[open_pairs], b[open_pairs]
        close = np.bitwise_count(sorted_prints[a] ^ sorted_prints[b]) <= distance
        absorb(labels, order[a[close]], order[b[close]])
    return labels


def _join_units(unit: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside each run of equal unit numbers."""
    labels = np.arange(len(prints))
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    sizes = np.diff(np.r_[starts, len(unit)])
    # A run that fits one leaf is compared as that leaf; all such runs go side by side.
    size_of = np.repeat(sizes, sizes)
    small = size_of <= LEAF
    for step in range(1, LEAF):
        a = np.flatnonzero(small[step:] & (unit[step:] == unit[:-step]))
        if not len(a):
            break
        close = np.bitwise_count(prints[a] ^ prints[a + step]) <= distance
        absorb(labels, a[close], a[close] + step)
    for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
        labels[start : start + size] = start + join_run(prints[start : start + size], distance)
    found = np.flatnonzero(labels != np.arange(len(labels)))
    return found, labels[found]


def _linker(distance: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            unit = np.cumsum(np.r_[0, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]) if rows.shape[1] else rows[0]
            a, b = _join_units(unit, rows[3].view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(rows[3][a]), pa.array(rows[3][b])], schema=schema)

        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if held.shape[1]:
                other = np.flatnonzero((held[:3] != held[:3, -1:]).any(axis=0))
                done = other[-1] + 1 if len(other) else 0
                if done:
                    yield links(held[:, :done])
                    held = held[:, done:].copy()
        if held.shape[1]:
            yield links(held)

    return run


def _low(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1))


def _filed(frame: DataFrame, width: int, blocks: int) -> DataFrame:
    """Once per block of the remaining bits: the block rotated to the top joins the key."""
    size = width // blocks
    kept = width - size
    at = [size * b for b in range(blocks)]
    turned = [
        _low(
            F.shiftleft(F.col("rest"), s).bitwiseOR(F.shiftrightunsigned(F.col("rest"), width - s)) if s else F.col("rest"),
            width,
        )
        if width < 64
        else (F.shiftleft(F.col("rest"), s).bitwiseOR(F.shiftrightunsigned(F.col("rest"), 64 - s)) if s else F.col("rest"))
        for s in at
    ]
    options = F.array(
        *[
            F.struct(
                (F.shiftleft(F.col("key"), 2 + size) + F.lit(number << size) + _low(F.shiftrightunsigned(y, kept), size)).alias("key"),
                _low(y, kept).alias("rest"),
            )
            for number, y in enumerate(turned)
        ]
    )
    return frame.select("fp", F.explode(options).alias("o")).select("fp", "o.key", "o.rest")


def links(
    prints: DataFrame,
    stash: Stash,
    unit_rows: int = UNIT_ROWS,
    refine_over: int = REFINE_OVER,
) -> DataFrame:
    """``(a, b)`` fingerprints that span everything linked at three or fewer differing bits.

    ``prints`` holds distinct fingerprints in the long column ``fp``.
    """
    routed = _filed(prints.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest")), 64, 4)
    parts, large = [], []
    # 64 bits in 4 blocks of 16, then 48 in 4 of 12, then 36 in 4 of 9: the key stays below 2**45.
    for width in (48, 36, 0):
        sizes = stash.put(
            routed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > unit_rows), "sizes"
        )
        refined = sizes.where(F.col("n") > refine_over) if width else sizes.limit(0)
        counted = routed.join(sizes, "key", "left")
        more = bool(width) and not refined.isEmpty()
        here = counted.where(F.coalesce("n", F.lit(0)) <= refine_over) if more else counted
        parts.append(here.select("fp", F.shiftleft("key", 2).bitwiseOR(F.lit(len(parts))).alias("key"), "n"))
        large.append(sizes)
        if not more:
            break
        routed = _filed(stash.put(routed.join(refined.select("key"), "key", "left_semi"), "refined"), width, 4)
    filed = parts[0]
    for part in parts[1:]:
        filed = filed.unionByName(part)
    pieces = F.greatest(F.ceil(F.coalesce("n", F.lit(1)) / unit_rows), F.lit(1)).cast("long")
    filed = filed.withColumn("pieces", pieces).withColumn("own", F.pmod(F.xxhash64("fp"), "pieces"))
    filed = filed.select("fp", "key", "own", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    units = filed.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    spread = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return spread.mapInArrow(_linker(DISTANCE), "a long, b long")


def fingerprints(docs: DataFrame, stash: Stash, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Stored ``(id, th, fp)``: id and text keys and the fingerprint, one row per document row."""
    return stash.put(
        docs.select(id_key(id_col).alias("id"), text_key(text).alias("th"), fingerprint(text).alias("fp")), "fingerprints"
    )


def groups(keyed: DataFrame, stash: Stash, **limits: int) -> DataFrame:
    """Stored ``(fp, label, component)`` for each distinct fingerprint; component is the smallest id key reached."""
    classes = stash.put(keyed.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    labels = stash.put(components(links(classes, stash, **limits), stash), "labels")
    named = stash.put(
        classes.join(labels, classes["fp"] == labels["node"], "left").select(
            "fp", "least", F.coalesce("label", "fp").alias("label")
        ),
        "named",
    )
    roots = stash.put(named.groupBy("label").agg(F.min("least").alias("component")), "roots")
    found = stash.put(named.join(roots, "label").select("fp", "label", "component"), "groups")
    stash.drop(classes, labels, named, roots)
    return found


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row."""
    stash = Stash(docs.sparkSession)
    keyed = fingerprints(docs, stash, text, id_col)
    found = groups(keyed, stash)
    return keyed.join(found, "fp").select(
        id_of("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        id_of("component").alias("component_id"),
    )


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with one of each group left: the one with the smallest id.

    Of equal ids in a group the one with the smallest text key stays, of equal rows one.
    """
    stash = Stash(docs.sparkSession)
    keyed = fingerprints(docs, stash, text, id_col)
    found = groups(keyed, stash)
    members = stash.put(keyed.join(found, "fp").where("id = component"), "members")
    kept = stash.put(
        members.groupBy("label").agg(F.min(F.struct("id", "th")).alias("k")).select("k.id", "k.th"), "kept"
    )
    key, th, place = fresh(docs, "id", "th", "place")
    marked = docs.withColumns({key: id_key(id_col), th: text_key(text)})
    chosen = marked.join(kept, (marked[key] == kept["id"]) & (marked[th] == kept["th"]), "left_semi")
    once = Window.partitionBy(key, th).orderBy(key)
    return chosen.withColumn(place, F.row_number().over(once)).where(F.col(place) == 1).select(docs.columns)

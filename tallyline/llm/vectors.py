"""Embedding near-dedup over an inverted multi-index.

Each half of a unit vector has a codebook of its own (k-means on a bounded sample), and
the grid of both is the index: a vector is filed under its nearest code pair. A query
walks the cells in the order of their distance, a multi-sequence traversal over the two
sorted lists of code distances. The distance of a cell is the sum of the squared
distances to its two half-spaces, so it never exceeds that of any vector in it. The walk
ends at the distance at which ``TARGET`` of partners just similar enough (made from
the sample) lie in cells seen. What the walk meets is verified by cosine in double precision.

Links have no direction, so a query walks only to cells with a smaller number than its
own; each pair is met once. Equal vectors are one class before the search and count with
their number. A cell with very many classes is cut into pieces that are units of work of
their own. Units emit, per class, how many vectors it links with there, and links
that span what is connected; never all pairs.

Defined results: vectors that are NULL, zero, or hold a NULL or non-finite component have
no link and are their own component; vectors of different lengths never link; rows with
equal ids are vectors of their own; rows without an id count as last and name a
component only where no row in it has an id (``component_id`` is then NULL, and
they are ``kept``); other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import Stash, bounded, id_key, id_of
from tallyline.llm.components import components
from tallyline.llm.forest import absorb

LIMIT = 0.95
TARGET = 0.999
SAMPLE = 8192
CODES = (4, 256)
CELL_ROWS = 1024
QUERY_BLOCK = 512


@dataclass
class Index:
    """Two codebooks, and how far a walk goes (squared distance)."""

    width: int
    first: np.ndarray
    second: np.ndarray
    reach: float = 0.0

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.width // 2
        return units[:, :cut], units[:, cut:]

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distance to each code's half-space, for both halves; and the home cell."""
        found, homes = [], []
        for part, codes in zip(self.halves(units), (self.first, self.second), strict=True):
            to_code = (codes**2).sum(axis=1) - 2 * part @ codes.T
            home = to_code.argmin(axis=1)
            gap = np.sqrt(np.maximum(((codes[home][:, None, :] - codes[None, :, :]) ** 2).sum(axis=2), 1e-300))
            beyond = (to_code - to_code[np.arange(len(part)), home][:, None]) / (2 * gap)
            beyond[np.arange(len(part)), home] = 0.0
            found.append(np.maximum(beyond, 0.0) ** 2)
            homes.append(home)
        return found[0], found[1], homes[0] * len(self.second) + homes[1]


def walk(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[float, int, int]]:
    """Multi-sequence traversal: code pairs by rising sum of distances, up to ``reach``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > reach:
            return
        yield total, int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def codebook(rows: np.ndarray, size: int, draw: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means codes of half vectors; codes are distinct."""
    distinct = np.unique(rows, axis=0)
    codes = distinct[draw.choice(len(distinct), min(size, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        near = ((codes**2).sum(axis=1) - 2 * rows @ codes.T).argmin(axis=1)
        counts = np.bincount(near, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, near, rows)
        codes[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return np.unique(codes, axis=0)


def build(units: np.ndarray, total: int, limit: float = LIMIT, target: float = TARGET, seed: int = 3) -> Index:
    """Codebooks and reach from a sample of unit vectors, for an index of ``total`` classes."""
    draw = np.random.default_rng(seed)
    width = units.shape[1]
    size = int(np.clip(2 ** round(np.log2(max(np.sqrt(total / CELL_ROWS), 1.0)) + 1), *CODES))
    cut = width // 2
    index = Index(width, codebook(units[:, :cut], size, draw), codebook(units[:, cut:], size, draw))
    # Partners at exactly the least similarity, in random directions, from the sample itself.
    some = units[: 4096]
    noise = draw.standard_normal(some.shape)
    noise -= (noise * some).sum(axis=1, keepdims=True) * some
    norm = np.linalg.norm(noise, axis=1, keepdims=True)
    partners = limit * some + np.sqrt(1 - limit**2) * noise / np.where(norm > 0, norm, 1.0)
    _, _, homes = index.distances(partners)
    a, b, _ = index.distances(some)
    at = np.arange(len(some))
    seen_at = a[at, homes // len(index.second)] + b[at, homes % len(index.second)]
    index.reach = float(np.quantile(seen_at, target, method="higher")) if len(some) else 0.0
    return index


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, without overflow."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _filer(index: Index | None):
    """Home cell and cells to visit of each class; other lengths share one cell per length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            sizes = np.diff(vectors.offsets.to_numpy())
            homes, visits = -sizes.astype(np.int64), [[] for _ in sizes]
            fit = np.flatnonzero(sizes == index.width) if index else np.zeros(0, np.int64)
            for at in range(0, len(fit), 1024):
                rows = fit[at : at + 1024]
                a, b, home = index.distances(unit_rows(_matrix(vectors.take(pa.array(rows)))))
                homes[rows] = home
                for k, first, second, own in zip(rows.tolist(), a, b, home.tolist(), strict=True):
                    cells = (i * len(index.second) + j for _, i, j in walk(first, second, index.reach))
                    visits[k] = [c for c in cells if c < own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), vectors, pa.array(homes), pa.array(visits, pa.list_(pa.int64()))],
                names=["node", "n", "v", "home", "visits"],
            )

    return run


class Unit:
    """The classes filed in one piece of a cell, and what queries have found there."""

    def __init__(self, limit: float):
        self.limit = limit
        self.parts: list[tuple] = []
        self.ready = False

    def file(self, nodes: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        self.parts.append((nodes, counts, values))

    def _close(self) -> None:
        self.nodes, self.counts, self.values = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.units = unit_rows(self.values)
        self.labels = np.arange(len(self.nodes))
        self.found = np.zeros(len(self.nodes), np.int64)
        self.ready = True
        for at in range(0, len(self.nodes), QUERY_BLOCK):
            rows = np.arange(at, min(at + QUERY_BLOCK, len(self.nodes)))
            hits = self._hits(self.units[rows], self.values[rows])
            hits &= np.arange(len(self.nodes))[None, :] > rows[:, None]
            self.found[rows] += hits @ self.counts
            self.found += self.counts[rows] @ hits
            i, j = np.nonzero(hits)
            absorb(self.labels, rows[i], j)

    def _hits(self, units: np.ndarray, values: np.ndarray) -> np.ndarray:
        likeness = units @ self.units.T
        hits = likeness >= self.limit
        # At the line itself the cosine is taken as it is defined.
        for q, x in zip(*np.nonzero(np.abs(likeness - self.limit) < 1e-9), strict=True):
            a, b = values[q].astype(np.float64), self.values[x].astype(np.float64)
            hits[q, x] = a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= self.limit
        return hits

    def ask(self, nodes: np.ndarray, counts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spanning links and link counts of some queries: (a, b, w) with b = -1 for counts."""
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        if not self.ready:
            self._close()
        hits = self._hits(unit_rows(values), values)
        own = hits @ self.counts
        self.found += counts @ hits
        q, x = np.nonzero(hits)
        some, first = np.unique(q, return_index=True)
        lead = np.zeros(len(nodes), np.int64)
        lead[some] = x[first]
        absorb(self.labels, lead[q], x)
        linked = np.flatnonzero(own)
        return (
            np.r_[nodes[some], nodes[linked]],
            np.r_[self.nodes[lead[some]], np.full(len(linked), -1)],
            np.r_[np.zeros(len(some), np.int64), own[linked]],
        )

    def rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The filed classes' own links and counts, once all queries are through."""
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        if not self.ready:
            self._close()
        joined = np.flatnonzero(self.labels != np.arange(len(self.labels)))
        linked = np.flatnonzero(self.found)
        return (
            np.r_[self.nodes[joined], self.nodes[linked]],
            np.r_[self.nodes[self.labels[joined]], np.full(len(linked), -1)],
            np.r_[np.zeros(len(joined), np.int64), self.found[linked]],
        )


def _searcher(limit: float):
    def out(columns: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["a", "b", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit = None, Unit(limit)
        for batch in batches:
            cell, piece = batch.column("cell").to_numpy(), batch.column("piece").to_numpy()
            role, nodes, counts = (batch.column(c).to_numpy() for c in ("role", "node", "n"))
            change = np.flatnonzero((cell[1:] != cell[:-1]) | (piece[1:] != piece[:-1]) | (role[1:] != role[:-1])) + 1
            for start, end in zip([0, *change.tolist()], [*change.tolist(), len(cell)], strict=True):
                if start == end:
                    continue
                if key != (cell[start], piece[start]):
                    yield out(unit.rest())
                    key, unit = (cell[start], piece[start]), Unit(limit)
                values = _matrix(batch.column("v").slice(start, end - start))
                if role[start] == 0:
                    unit.file(nodes[start:end], counts[start:end], values)
                    continue
                for at in range(start, end, QUERY_BLOCK):
                    to = min(at + QUERY_BLOCK, end)
                    yield out(unit.ask(nodes[at:to], counts[at:to], values[at - start : to - start]))
        yield out(unit.rest())

    return run


def _usable(vector: str) -> F.Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit(classes: DataFrame, total: int, limit: float = LIMIT, target: float = TARGET, sample: int = SAMPLE) -> Index | None:
    """Index for the most frequent vector length, from a bounded sample of the classes."""
    widths = classes.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None or widths["width"] < 2:
        return None
    drawn = bounded(classes.where(F.size("v") == widths["width"]).select("v"), sample, widths["n"], "v").collect()
    return build(unit_rows(np.array([r["v"] for r in drawn], np.float64)), total, limit, target)


def near_duplicates(
    embeddings: DataFrame,
    vector: str = "embedding",
    id_col: str = "vec_id",
    limit: float = LIMIT,
    target: float = TARGET,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row."""
    stash = Stash(embeddings.sparkSession)
    rows = embeddings.select(id_key(id_col).alias("id"), F.col(vector).alias("v"))
    good = rows.where(_usable("v"))
    classes = good.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = stash.put(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    index = fit(classes, classes.count(), limit, target)
    kind = classes.schema["v"].dataType.simpleString()
    filed = classes.select("node", "n", "v").mapInArrow(
        _filer(index), f"node long, n long, v {kind}, home long, visits array<long>"
    )
    filed = stash.put(filed, "filed")
    sizes = filed.groupBy("home").agg(F.ceil(F.count("*") / cell_rows).cast("long").alias("pieces"))
    sizes = stash.put(sizes.withColumnRenamed("home", "cell"), "sizes")
    routes = filed.select("node", "n", "v", "home", F.explode(F.concat(F.array("home"), "visits")).alias("cell"))
    routes = routes.join(sizes, "cell")
    own = F.when(F.col("cell") == F.col("home"), F.pmod(F.xxhash64("node"), "pieces"))
    routes = routes.withColumn("own", own).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("own", F.col("pieces") - 1)))
    )
    role = F.when(F.col("piece") == F.col("own"), 0).otherwise(1).cast("long")
    units = routes.select("cell", "piece", role.alias("role"), "node", "n", "v")
    spread = units.repartition("cell", "piece").sortWithinPartitions("cell", "piece", "role")
    found = stash.put(spread.mapInArrow(_searcher(limit), "a long, b long, w long"), "found")
    counts = found.where("b = -1").groupBy(F.col("a").alias("of")).agg(F.sum("w").alias("links"))
    labels = components(found.where("b <> -1").select("a", "b"), stash)
    named = classes.select("node", "least", "n").join(labels, "node", "left")
    named = stash.put(named.select("node", "least", "n", F.coalesce("label", "node").alias("label")), "named")
    roots = stash.put(named.groupBy("label").agg(F.min("least").alias("component")), "roots")
    counted = named.join(roots, "label").join(counts, F.col("node") == F.col("of"), "left")
    facts = counted.select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component")
    facts = stash.put(classes.select("node", F.col("v").alias("cv")).join(facts, "node").drop("node"), "facts")
    joined = good.join(facts, good["v"] == facts["cv"]).select("id", "n_links", "component")
    alone = rows.where(~_usable("v")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return joined.unionByName(alone).select(
        id_of("id").alias("vec_id"),
        "n_links",
        id_of("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )

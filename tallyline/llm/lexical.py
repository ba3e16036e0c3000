"""Ranked lexical search by MaxScore with pair bounds.

The query set is worked on in groups of a bounded number of (item, term) pairs. For a
group, one pass over the documents builds an inverted index of its terms: rows of
bounded blocks of documents with postings by term. From the index come the statistics
(documents, words, documents per term), then the impacts, and beside them the pair
lists: for chosen pairs of terms that items share, the documents of a block that hold
both, with their joint impacts and the greatest of these. Both are stored.

A search task walks its blocks and keeps each item's best documents so far; the least
of them is the threshold. A pair can add no more than the greatest of its two terms'
maxima and its joint maximum, which is less than the sum of the maxima wherever the two
peak in different documents. Units (pairs, and terms without a pair) are ordered by
that bound; the longest prefix whose bounds sum to less than the threshold is not
essential, as a document with nothing else cannot get in. Documents of the other units
are scored, then the prefix is added from its greatest unit down, and documents that
cannot reach the threshold any more are left out before each step. All arithmetic is in
64-bit integers, so results do not depend on blocks or order.

Which pairs get lists: an item's terms from the rarest up, two by two, cheapest pairs
first, as long as the lists hold at most as many documents as the postings do. This
decides the work only.

Defined results: a NULL or empty text holds no term; an item without terms, or whose
terms no document holds, gets no rows; each row of the items is an item, also where
ids repeat; documents without an id come last among equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import NO_ID, Stash, id_key, id_of
from tallyline.llm.rawtext import folded_words, need_integer, slices

DEPTH = 10
LENGTH_PERCENT = 90  # share of the length in the damping of a term's count
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 19
GROUP_PAIRS = 200_000
UNIT = 1_000_000_000

INDEX = "ids array<long>, lengths array<long>, terms array<int>, begins array<int>, docs array<int>, counts array<long>"
LISTS = (
    "ids array<long>, terms array<int>, begins array<int>, docs array<int>, impacts array<long>, "
    "pairs array<int>, pair_begins array<int>, pair_docs array<int>, joint array<long>, peaks array<long>"
)


@dataclass
class Items:
    """A group of items: their ids, and the numbers of their distinct terms."""

    ids: list[int | None] = field(default_factory=list)
    terms: list[list[int]] = field(default_factory=list)
    numbers: dict[bytes, int] = field(default_factory=dict)
    pairs: int = 0

    def add(self, ident: int | None, words: list[bytes]) -> None:
        self.ids.append(ident)
        self.terms.append([self.numbers.setdefault(w, len(self.numbers)) for w in words])
        self.pairs += len(words)


def groups(items: DataFrame, most: int = GROUP_PAIRS) -> Iterator[Items]:
    """The items in groups of up to ``most`` (item, term) pairs, or of one item; one group at a time is held."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at, size in slices(texts):
                words = [list(dict.fromkeys(folded_words(t or b""))) for t in texts.slice(at, size).to_pylist()]
                made = [batch.column("item_id").slice(at, size), pa.array(words, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(made, names=["item_id", "words"])

    given = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    group = Items()
    for row in given.mapInArrow(distinct, "item_id long, words array<binary>").toLocalIterator():
        words = [bytes(w) for w in row["words"]]
        if group.ids and group.pairs + len(words) > most:
            yield group
            group = Items()
        if words:
            group.add(row["item_id"], words)
    if group.ids:
        yield group


def _postings(ids: list[np.ndarray], lengths: list[np.ndarray], keys: list[np.ndarray], width: int) -> pa.RecordBatch:
    """One block of the index, from the (document, term) of each word that a query has."""
    key, counts = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    docs, terms = key // width, key % width
    order = np.argsort(terms, kind="stable")
    found, begins = np.unique(terms[order], return_index=True)
    columns = [
        (np.concatenate(ids), pa.int64()), (np.concatenate(lengths), pa.int64()), (found, pa.int32()),
        (np.r_[begins, len(order)], pa.int32()), (docs[order], pa.int32()), (counts[order], pa.int64()),
    ]
    arrays = [pa.array([values], pa.list_(kind)) for values, kind in columns]
    return pa.RecordBatch.from_arrays(arrays, names=["ids", "lengths", "terms", "begins", "docs", "counts"])


def index(docs: DataFrame, numbers: dict[bytes, int], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Blocks of postings of the given terms; documents without any word have length 0."""
    width = max(len(numbers), 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, keys, held, size_of = [], [], [], 0, 0
        number = numbers.get
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at, size in slices(texts):
                words = [folded_words(t) if t else [] for t in texts.slice(at, size).to_pylist()]
                count = np.fromiter(map(len, words), np.int64, size)
                found = np.array([number(w, -1) for w in chain.from_iterable(words)], np.int64)
                place = np.repeat(np.arange(held, held + size), count)[found >= 0]
                ids.append(batch.column("id").slice(at, size).to_numpy())
                lengths.append(count)
                keys.append(place * width + found[found >= 0])
                held, size_of = held + size, size_of + len(keys[-1])
                if held >= block_docs or size_of >= BLOCK_POSTINGS:
                    yield _postings(ids, lengths, keys, width)
                    ids, lengths, keys, held, size_of = [], [], [], 0, 0
        if held:
            yield _postings(ids, lengths, keys, width)

    given = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("string"))
    return given.mapInArrow(build, INDEX)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Each block as arrays."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].values.to_numpy(zero_copy_only=False) for name in batch.schema.names}


def statistics(blocks: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a word, words of all documents, documents per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 2, np.int64)
        for block in _rows(batches):
            total[block["terms"]] += np.diff(block["begins"])
            total[terms] += np.count_nonzero(block["lengths"])
            total[terms + 1] += block["lengths"].sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    made = np.zeros(terms + 2, np.int64)
    parts = blocks.select("lengths", "terms", "begins").mapInArrow(count, "term long, n long")
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row per term of the group at most
        made[row["term"]] = row["n"]
    return int(made[terms]), int(made[terms + 1]), made[:terms]


def weights(held: int, per_term: np.ndarray) -> np.ndarray:
    """Floored, scaled log of how rare each term is."""
    return np.array([math.floor(1000 * math.log((2 * held + 2) / (2 * n + 1))) for n in per_term.tolist()], np.int64)


def chosen_pairs(items: Items, per_term: np.ndarray) -> tuple[list[tuple[int, int]], list[list[tuple[int, ...]]]]:
    """The pairs that get lists, and each item's units: numbers of pairs (-1 for none) with their terms."""
    wanted: dict[tuple[int, int], int] = {}
    ordered = [sorted(terms, key=lambda t: (per_term[t], t)) for terms in items.terms]
    for terms in ordered:
        for a, b in zip(terms[::2], terms[1::2], strict=False):
            wanted[a, b] = int(per_term[a])
    room, pairs = int(per_term.sum()), {}
    for pair, cost in sorted(wanted.items(), key=lambda w: (w[1], w[0])):
        if room < cost:
            break
        room -= cost
        pairs[pair] = len(pairs)
    units = []
    for terms in ordered:
        mine: list[tuple[int, ...]] = []
        for k in range(0, len(terms), 2):
            two = tuple(terms[k : k + 2])
            mine += [(pairs[two], *two)] if two in pairs else [(-1, t) for t in two]
        units.append(mine)
    return list(pairs), units


def pair_lists(blocks: DataFrame, held: int, words: int, weight: np.ndarray, pairs: list[tuple[int, int]]) -> DataFrame:
    """The blocks with impacts instead of counts, and the lists of the chosen pairs."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows(batches):
            terms, begins, docs = block["terms"], block["begins"], block["docs"]
            size = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * block["lengths"] * held) // words
            counts = block["counts"]
            impacts = np.repeat(weight[terms], np.diff(begins)) * ((UNIT * counts) // (1000 * counts + 8 * size[docs]))
            place = dict(zip(terms.tolist(), range(len(terms)), strict=True))
            at = np.full(len(block["ids"]), -1, np.int64)
            kept, ends, both, joint, peaks = [], [0], [], [], []
            for k, (a, b) in enumerate(pairs):
                if a in place and b in place:
                    i, j = place[a], place[b]
                    mine, other = slice(begins[i], begins[i + 1]), slice(begins[j], begins[j + 1])
                    at[docs[mine]] = np.arange(begins[i], begins[i + 1])
                    seen = at[docs[other]]
                    at[docs[mine]] = -1
                    if (seen >= 0).any():
                        kept.append(k)
                        both.append(docs[other][seen >= 0])
                        joint.append(impacts[other][seen >= 0] + impacts[seen[seen >= 0]])
                        peaks.append(int(joint[-1].max()))
                        ends.append(ends[-1] + len(both[-1]))
            columns = [
                (block["ids"], pa.int64()), (terms, pa.int32()), (begins, pa.int32()), (docs, pa.int32()), (impacts, pa.int64()),
                (kept, pa.int32()), (ends, pa.int32()), (np.concatenate([[], *both]).astype(np.int32), pa.int32()),
                (np.concatenate([np.zeros(0, np.int64), *joint]), pa.int64()), (peaks, pa.int64()),
            ]
            arrays = [pa.array([values], pa.list_(kind)) for values, kind in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in LISTS.split(", ")])

    return blocks.mapInArrow(build, LISTS)


class Block:
    """Postings and pair lists of one block, by term and by pair."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.ids, self.docs, self.impacts = row["ids"], row["docs"], row["impacts"]
        self.pair_docs, self.joint = row["pair_docs"], row["joint"]
        self.begins, self.pair_begins = row["begins"].tolist(), row["pair_begins"].tolist()
        self.term_at = {t: k for k, t in enumerate(row["terms"].tolist())}
        self.pair_at = {p: k for k, p in enumerate(row["pairs"].tolist())}
        tops = np.maximum.reduceat(self.impacts, row["begins"][:-1]) if len(self.impacts) else np.zeros(0, np.int64)
        self.tops, self.peaks = tops.tolist(), row["peaks"].tolist()

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.term_at[term]
        here = slice(self.begins[k], self.begins[k + 1])
        return self.docs[here], self.impacts[here]

    def pair(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.pair_at[number]
        here = slice(self.pair_begins[k], self.pair_begins[k + 1])
        return self.pair_docs[here], self.joint[here]

    def bound(self, unit: tuple[int, ...]) -> int:
        """The most that a unit adds to a document here; 0 if it is not here at all."""
        pair, *terms = unit
        most = max((self.tops[self.term_at[t]] for t in terms if t in self.term_at), default=0)
        return max(most, self.peaks[self.pair_at[pair]]) if pair in self.pair_at else most


def _looked_up(at: np.ndarray, docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the documents ``at`` the list holds, and what it has for those."""
    place = np.minimum(np.searchsorted(docs, at), len(docs) - 1)
    hit = docs[place] == at
    return hit, values[place[hit]]


def best_of_block(block: Block, units: list[tuple[int, ...]], threshold: int, depth: int, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that may be among the best, with their scores; ``scores`` is zero before and after.

    Documents below the threshold may be left out, those at or above it are not.
    """
    here = sorted(((bound, unit) for unit in units if (bound := block.bound(unit))), reverse=True)
    below = np.cumsum([0, *(bound for bound, _ in reversed(here))])[::-1]  # what the units from k on add at most
    essential = next((k for k in range(len(here) + 1) if below[k] < threshold), len(here))
    lists = [block.postings(t) for _, (_, *terms) in here[:essential] for t in terms if t in block.term_at]
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for docs, impacts in lists:
        scores[docs] += impacts
    touched = np.flatnonzero(scores)
    at, value = touched, scores[touched]
    scores[touched] = 0
    for k in range(essential, len(here)):
        alive = value + below[k] >= max(threshold, 1)
        at, value = at[alive], value[alive]
        if not len(at):
            break
        pair, *terms = here[k][1]
        left = np.ones(len(at), bool)
        if pair in block.pair_at:  # documents that hold both have their sum in the pair's list
            hit, more = _looked_up(at, *block.pair(pair))
            value[hit] += more
            left[hit] = False
        for term in terms:
            if term in block.term_at:
                rest = np.flatnonzero(left)
                hit, more = _looked_up(at[rest], *block.postings(term))
                value[rest[hit]] += more
    keep = value >= max(threshold, 1)
    return at[keep], value[keep]


def _search(units: list[list[tuple[int, ...]]], depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in units]
        for row in _rows(batches):
            block, scores = Block(row), np.zeros(len(row["ids"]), np.int64)
            for k, mine in enumerate(units):
                ids, values = best[k]
                at, found = best_of_block(block, mine, int(values[-1]) if len(values) >= depth else 0, depth, scores)
                if len(at):
                    ids, values = np.r_[ids, block.ids[at]], np.r_[values, found]
                    order = np.lexsort((ids, -values))[:depth]
                    best[k] = ids[order], values[order]
        item = np.repeat(np.arange(len(units)), [len(ids) for ids, _ in best])
        made = [item, np.concatenate([np.zeros(0, np.int64), *(b[0] for b in best)]), np.concatenate([np.zeros(0, np.int64), *(b[1] for b in best)])]
        yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=["item", "id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``depth`` best documents.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are ignored.
    """
    need_integer(docs, "doc_id")
    need_integer(items, "item_id")
    spark, made = docs.sparkSession, []
    stash = Stash(spark)
    for group in groups(items):
        blocks = stash.put(index(docs, group.numbers), "postings")
        held, words, per_term = statistics(blocks, len(group.numbers))
        if held:
            pairs, units = chosen_pairs(group, per_term)
            lists = stash.put(pair_lists(blocks, held, words, weights(held, per_term), pairs), "pair-lists")
            stash.drop(blocks)
            found = lists.mapInArrow(_search(units, depth), "item long, id long, score long")
            place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "id"))
            top = found.withColumn("rank", place).where(F.col("rank") <= depth)
            names = spark.createDataFrame(list(enumerate(group.ids)), "item long, item_id long")
            answers = top.join(F.broadcast(names), "item")  # as many rows as the group has items
            made.append(stash.put(answers.select("item_id", "rank", id_of("id").alias("doc_id"), "score"), "answers"))
            stash.drop(lists)
    if not made:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = made[0]
    for more in made[1:]:
        whole = whole.unionByName(more)
    return whole

"""Importance resampling toward a target corpus over hashed word features.

Features are runs of consecutive words, hashed into buckets. Bucket counts over all
documents and over the target give each bucket a gain, the logarithm of how much more
likely the target is to have it; a document's weight is the floored mean of its
features' gains, looked up in one array. Drawing without replacement is Gumbel top-k:
a draw by hash of the id is added to the weight, and the highest sums are taken.

Ranks come from a distributed radix sort (:mod:`tallyline.llm.radix`) by score
downward, id upward and, where rows share an id, number of features upward.

Defined results: a text that is NULL or has no word has no features, weight 0 and, under
the least number of words, no rank; a row without an id draws by an empty id and comes
after rows with one; equal rows are ranked one after the other. An empty target gives
equal gains by the documents alone; with no documents there are no rows. The features
and draws of a document depend on its text and id and on all documents, nothing else.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import Stash, id_key, id_of
from tallyline.llm.radix import positions
from tallyline.llm.rawtext import folded_words, need_integer, slices, sums

BUCKETS = 10_000
ORDER = 1
SCALE = 1000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
MEMO_WORDS = 200_000
MEMO_WORD_BYTES = 48


class BucketMemo(dict):
    """Bucket of each feature; short ones are remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= MEMO_WORD_BYTES and len(self) < MEMO_WORDS:
            self[feature] = bucket
        return bucket


def features(words: list[bytes], order: int) -> list[bytes]:
    """All runs of 1 to ``order`` consecutive words."""
    runs = [words[k:] for k in range(order)]
    return words if order == 1 else [b" ".join(run) for n in range(1, order + 1) for run in zip(*runs[:n], strict=False)]


def _bucketed(batches: Iterator[pa.RecordBatch], buckets: int, order: int):
    """Per slice: the batch's stretch, buckets of all features, features and words per text."""
    memo = BucketMemo(buckets)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at, size in slices(texts):
            words = [folded_words(t) if t else [] for t in texts.slice(at, size).to_pylist()]
            runs = [features(w, order) for w in words]
            lengths = np.fromiter(map(len, runs), np.int64, size)
            found = np.fromiter(map(memo.__getitem__, chain.from_iterable(runs)), np.int64, int(lengths.sum()))
            yield batch.slice(at, size), found, lengths, np.fromiter(map(len, words), np.int64, size)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """Features in each bucket over the whole column ``text``; one array of ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, found, *_ in _bucketed(batches, buckets, order):
            total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    made = np.zeros(buckets, np.int64)
    parts = texts.select("text").mapInArrow(count, "bucket long, n long")
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        made[row["bucket"]] = row["n"]
    return made


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored, scaled log ratio of the smoothed chances of each bucket."""
    buckets, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(scale * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))) for s, t in pairs], np.int64)


def _weigh(gain: np.ndarray, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, lengths, words in _bucketed(batches, len(gain), order):
            weight = sums(gain[found], lengths) // np.maximum(lengths, 1)
            made = [batch.column("id"), pa.array(words), pa.array(lengths), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(made, names=["id", "n_words", "n_features", "weight"])

    return run


def draw(key: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Floored, scaled Gumbel draw from the first eight hex digits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_of(key).cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-scale * F.log(-F.log((hashed + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document.

    ``docs`` has ``doc_id`` (an integer) and ``text``, ``target`` has ``text``; other
    columns are ignored. Of the N documents with enough words the ``percent`` of them
    with the highest scores, rounded down, are drawn and ranked from 1.
    """
    need_integer(docs, "doc_id")
    stash = Stash(docs.sparkSession)
    gain = gains(bucket_counts(docs, buckets, order), bucket_counts(target, buckets, order))
    given = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("string"))
    weighed = given.mapInArrow(_weigh(gain, order), "id long, n_words long, n_features long, weight long")
    scored = stash.put(weighed.withColumn("score", F.col("weight") + draw(F.col("id"), seed)), "weights")
    able = F.col("n_words") >= least_words
    placed = positions(scored.where(able), [("score", True), ("id", False), ("n_features", False)], stash)
    drawn = scored.where(able).count() * percent // 100
    ranked = placed.withColumn("rank", F.when(F.col("at") < drawn, F.col("at") + 1)).drop("at")
    short = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short).select(id_of("id").alias("doc_id"), "n_features", "weight", "score", "rank")

"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes. A chunk ends where the hash of the last sixteen
bytes meets a mask: a light mask after white space, so that chunks are whole words
where a text has words, and a heavier one at any other character, so that text without
white space is cut too. Boundaries depend on these bytes only, so after an insertion
the chunks fall back into step. Chunks are told apart by their 64-bit digest.

A chunk repeats if a document with a smaller id has it. Consecutive repeating chunks
are a run, and a run of ``min_words`` words or more is cut from the text. A stretch of
more than ``LONG_BYTES`` bytes without white space counts as a word for each ``WORD_BYTES``
of them, so that text without white space is cut as text with it is. The first document
keeps its copy, so a surviving copy of every cut chunk exists. Shorter runs are common
phrases and stay. A text that an earlier document has as a whole goes whatever its
length; its digest, by a seed of its own, stands behind those of its chunks.

Digests are combined per task before the shuffle, digests found in one document only
are dropped before the join, and a digest that very many documents have is one row per
task there; the join of its chunks is split by Spark when skewed.

Defined results: NULL text stays NULL, empty text stays empty, a text that repeats as a
whole becomes empty and its row stays; rows without an id count as last, and rows with
equal ids do not repeat each other; other columns pass through; an empty table gives
no rows.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Stash, fresh, id_key, text_key

WINDOW = 16
MIN_BYTES = 12
MIN_WORDS = 25
LONG_BYTES = 30
WORD_BYTES = 6
WORD_MASK = 0x6000
ANY_MASK = 0xFE00


def gear_table(seed: int = 7) -> np.ndarray:
    """One random 16-bit value per byte, from the seed."""
    draw = random.Random(seed)
    return np.array([draw.getrandbits(16) for _ in range(256)], np.uint16)


GEAR = gear_table()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte over the last sixteen, for all bytes at once.

    ``h[i] = sum(GEAR[data[i - k]] << k)`` in 16 bits; spans of 1, 2, 4 and 8 are
    doubled, which is the same sum as rolling byte by byte.
    """
    hashes = GEAR[data]
    span = 1
    while span < WINDOW:
        wider = hashes.copy()
        wider[span:] += hashes[:-span] << np.uint16(span)
        hashes, span = wider, span * 2
    return hashes


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks, the last one the length of the text."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return []
    hashes = gear_hashes(data)
    # A chunk may end before a byte that starts a character.
    starts_next = np.r_[(data[1:] & 0xC0) != 0x80, True]
    space = _SPACE[data]
    ends = np.flatnonzero(np.where(space, (hashes & WORD_MASK) == 0, ((hashes & ANY_MASK) == 0) & starts_next)) + 1
    kept, last = [], 0
    for end in ends.tolist():
        if end - last >= MIN_BYTES:
            kept.append(end)
            last = end
    if last < len(data):
        kept.append(len(data))
    return kept


@F.arrow_udf(T.ArrayType(T.LongType()))
def _digests(texts: pa.Array) -> pa.Array:
    offsets, values = [0], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        if text.is_valid:
            data = text.as_buffer().to_pybytes()
            last = 0
            for end in cuts(data):
                values.append(digest(data[last:end]))
                last = end
            if last:
                values.append(digest(data, 1))
        offsets.append(len(values))
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(np.array(values, np.uint64).view(np.int64))
    )


def digests(text: Column | str) -> Column:
    """Digest of each chunk, in order, and last the digest of a text that has any as a whole."""
    return _digests(text)


def _runs(repeated: list[int]) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    found: list[tuple[int, int]] = []
    for number in repeated:
        if found and number == found[-1][1] + 1:
            found[-1] = (found[-1][0], number)
        else:
            found.append((number, number))
    return found


def amount(text: bytes) -> int:
    """Words, a long stretch without white space as many as its bytes would make."""
    return sum(1 if len(w) <= LONG_BYTES else len(w) // WORD_BYTES for w in text.split())


def repeated_spans(text: bytes, repeated: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Byte spans to cut: a text that repeats as a whole, else runs of repeating chunks with enough words."""
    ends = cuts(text)
    if len(repeated) > len(ends):
        return [(0, len(text))]
    spans = []
    for first, last in _runs(sorted(n for n in repeated if n < len(ends))):
        start, end = (ends[first - 1] if first else 0), ends[last]
        if amount(text[start:end]) >= min_words:
            spans.append((start, end))
    return spans


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_CUT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
        T.StructField("words", T.LongType()),
    ]
)


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, repeated: pa.Array, least: pa.Array) -> pa.Array:
    made = []
    for text, numbers, words in zip(texts, repeated, least, strict=True):
        if not text.is_valid:
            made.append(None)
            continue
        data = text.as_buffer().to_pybytes()
        spans = repeated_spans(data, numbers.as_py(), words.as_py())
        left, last, gone = [], 0, 0
        for start, end in spans:
            left.append(data[last:start])
            gone += len(data[start:end].split())
            last = end
        left.append(data[last:])
        places = [
            {"start": len(data[:start].decode()), "end": len(data[:end].decode())} for start, end in spans
        ]
        made.append({"text": b"".join(left).decode(), "spans": places, "words": gone})
    kind = pa.struct(
        [
            ("text", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("words", pa.int64()),
        ]
    )
    return pa.array(made, kind)


def repeats(docs: DataFrame, stash: Stash, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Stored ``(id, th, numbers)``: which chunks of a document an earlier document has."""
    # Hashed once: counts and join read the stored digests, and explode puts no second call of the UDF into a filter.
    hashed = docs.select(id_key(id_col).alias("id"), text_key(text).alias("th"), digests(text).alias("d"))
    listed = stash.put(hashed, "digests")
    seen = (
        listed.select("id", F.explode("d").alias("digest"))
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select("digest", "first")
    )
    shared = stash.put(seen, "shared")
    placed = listed.select("id", "th", F.posexplode("d").alias("number", "digest"))
    later = placed.join(shared, "digest").where("first < id").select("id", "th", "number")
    later = stash.put(later, "later")
    numbers = stash.put(later.groupBy("id", "th").agg(F.collect_set("number").alias("numbers")), "numbers")
    stash.drop(listed, shared, later)
    return numbers


def cut_repeats(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS, detail: bool = False
) -> DataFrame:
    """The documents without passages that an earlier document has.

    With ``detail`` the columns ``removed_spans`` (start and end in code points of the
    given text) and ``removed_words`` follow.
    """
    key, th, cut, found_key, found_th, numbers = fresh(docs, "id", "th", "cut", "found_id", "found_th", "numbers")
    found = repeats(docs, Stash(docs.sparkSession), text, id_col).toDF(found_key, found_th, numbers)
    marked = docs.withColumns({key: id_key(id_col), th: text_key(text)})
    joined = marked.join(found, (F.col(key) == F.col(found_key)) & (F.col(th) == F.col(found_th)), "left")
    # Only the texts with a repeating chunk are handed to Python.
    touched = F.col(numbers).isNotNull()
    done = joined.withColumn(cut, _cut(F.when(touched, F.col(text)), numbers, F.lit(min_words)))
    left = F.when(touched, F.col(cut)["text"]).otherwise(F.col(text)).alias(text)
    columns = [left if c == text else F.col(c) for c in docs.columns]
    if detail:
        no_spans = F.array().cast("array<struct<start:int,end:int>>")
        columns += [
            F.coalesce(F.col(cut)["spans"], no_spans).alias("removed_spans"),
            F.coalesce(F.col(cut)["words"], F.lit(0).cast("long")).alias("removed_words"),
        ]
    return done.select(columns)

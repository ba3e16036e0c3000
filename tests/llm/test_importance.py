import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import importance, radix
from tallyline.llm.common import Stash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, order):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[k : k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1)]


def brute(docs, target, percent, least, buckets, order):
    """Rows of (id, n_features, weight, score, rank), sorted."""
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    seen = [(i, *runs(t, order)) for i, t in docs]
    s, t = Counter(crc(f) for *_, fs in seen for f in fs), Counter(crc(f) for x in target for f in runs(x, order)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    made = []
    for ident, words, fs in seen:
        h = int(hashlib.sha256(f"2024:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc(f)] for f in fs) // len(fs) if fs else 0
        made.append([ident, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((m for m in made if m[5] >= least), key=lambda m: (-m[3], m[0] is None, m[0] or 0, m[1]))
    for place, m in enumerate(able[: len(able) * percent // 100]):
        m[4] = place + 1
    return sorted((tuple(m[:5]) for m in made), key=str)


def words_of(draw, n):
    return " ".join(draw.choice(["the", "Of", "ÉTÉ", "x1", "-", "zq", "日本", "don't", "w%d" % draw.randrange(40)]) for _ in range(n))


@pytest.mark.parametrize("order, buckets, percent, least", [(1, 10_000, 10, 20), (2, 50, 100, 1), (3, 7, 35, 5)])
def test_equals_brute_force(spark, order, buckets, percent, least):
    draw = random.Random(order)
    rows = [(k, words_of(draw, draw.randrange(60))) for k in range(300)]
    rows += [(5, rows[5][1]), (5, "another text of five"), (None, None), (None, words_of(draw, 30)), (7000, ""), (-3, "a " * 5000), (2**62, None)]
    target = [words_of(draw, 10) for _ in range(9)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("clash"), "block": F.lit(0), "id": F.lit(1)})
    aim = spark.createDataFrame([(t,) for t in target], "text string").withColumn("doc_id", F.lit("clash"))
    made = importance.resample(docs.repartition(5), aim, percent, least, buckets, order)
    assert made.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows, target, percent, least, buckets, order)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, none).count() == 0
    some = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    rows = importance.resample(some, none, percent=100, least_words=0).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2]
    assert all(r["rank"] is None for r in importance.resample(some, none).collect())


def test_text_ids_are_refused(spark):
    with pytest.raises(ValueError, match="doc_id"):
        importance.resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), spark.createDataFrame([("b",)], "text string"))


def test_full_memo(monkeypatch):
    monkeypatch.setattr(importance, "MEMO_WORDS", 2)
    memo = importance.BucketMemo(97)
    words = [b"a", b"b", b"c", b"d" * 100, b"a"]
    assert [memo[w] for w in words] == [zlib.crc32(w) % 97 for w in words] and len(memo) == 2


def test_digits_cover_keys():
    top, low = 2**63 - 1, -(2**63)
    keys = [("a", low, top, True), ("b", 5, 5, False), ("c", -7, 2000, False)]
    made = radix.digits(keys)
    assert [d.column for d in made] == ["c", *["a"] * 6]  # 64 bits in six passes, none for a key of one value
    values = np.array([low, -1, 0, 1, top])
    rank = np.zeros(5, object)
    for d in reversed(made[1:]):
        rank = rank * (d.mask + 1) + d.of(values)
    assert rank.tolist() == [top - int(v) for v in values]


@pytest.mark.parametrize("block_bits", [2, 13])
def test_radix_positions(spark, monkeypatch, block_bits):
    monkeypatch.setattr(radix, "BLOCK_BITS", block_bits)
    draw = random.Random(3)
    rows = [(draw.choice([0, 0, 0, -5, 2**40, -(2**62)]), draw.randrange(-9, 9), k) for k in range(500)]
    frame = spark.createDataFrame(rows, "a long, b long, k long").repartition(7)
    made = radix.positions(frame, [("a", True), ("b", False), ("k", False)], Stash(spark)).collect()
    assert sorted(r["at"] for r in made) == list(range(500))
    found = [(r["a"], r["b"], r["k"]) for r in sorted(made, key=lambda r: r["at"])]
    assert found == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))


def test_radix_of_equal_and_no_rows(spark):
    same = spark.range(0, 40, 1, 3).select(F.lit(4).cast("long").alias("a"))
    assert sorted(r["at"] for r in radix.positions(same, [("a", False)], Stash(spark)).collect()) == list(range(40))
    assert radix.positions(same.limit(0), [("a", False)], Stash(spark)).count() == 0
    with pytest.raises(ValueError, match="block"):
        radix.positions(spark.range(1).withColumn("Block", F.lit(1)), [("id", False)], Stash(spark))

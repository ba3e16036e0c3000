import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyline.llm import simhash
from tallyline.llm.common import Stash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    """The contract's words, one bit at a time."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(prints))]


def flip(value, draw, bits):
    for b in draw.sample(range(64), bits):
        value ^= 1 << b
    return value


def signed(values):
    return np.array(values, np.uint64).view(np.int64).tolist()


def test_gray_rank():
    order = simhash.gray_rank(np.arange(64, dtype=np.uint64))
    assert sorted(order.tolist()) == list(range(64))
    code = np.argsort(order)
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(code, code[1:], strict=False))


def test_fingerprint_equals_contract():
    draw = random.Random(1)
    texts = ["", " \t\n", "One", "one two", "a b c", "É É\x0bÀ z\xa0y", "w " * 500]
    texts += [" ".join(draw.choice(["Ab", "cd", "ef", "ß"]) for _ in range(draw.randint(1, 90))) for _ in range(30)]
    for text in texts:
        assert simhash.fingerprint_of(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint_of(None) == 0


def test_run_join_equals_brute_force():
    draw = random.Random(2)
    prints = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(400):
        prints.append(flip(draw.choice(prints), draw, draw.randint(1, 6)))
    prints = list(dict.fromkeys(prints))
    found = simhash.join_run(np.array(prints, np.uint64))
    wanted = plain_components(prints, list(range(len(prints))))
    assert found.tolist() == wanted


def spread_prints(draw):
    """Random ones, chains of near ones, and many that share a block."""
    prints = [draw.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        prints.append(flip(draw.choice(prints), draw, draw.randint(1, 5)))
    base = draw.getrandbits(64)
    for _ in range(150):
        prints.append((base & ~((1 << 48) - 1)) | draw.getrandbits(48))
    return list(dict.fromkeys(prints))


def test_links_survive_splitting(spark):
    draw = random.Random(3)
    prints = spread_prints(draw)
    frame = spark.createDataFrame([(x,) for x in signed(prints)], "fp long").withColumn("id", F.monotonically_increasing_id())
    wanted = plain_components(prints, list(range(len(prints))))
    for limits in ({}, {"unit_rows": 8, "refine_over": 10**6}, {"unit_rows": 4, "refine_over": 20}):
        stash = Stash(spark)
        rows = simhash.groups(frame, stash, **limits).collect()
        at = {r["fp"]: r["label"] for r in rows}
        groups = {}
        for x, w in zip(signed(prints), wanted, strict=True):
            groups.setdefault(w, set()).add(at[x])
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_query_shape_and_edges(spark):
    long = "x y z " * 4000
    rows = [
        (5, "Same words here today", None, None, None),
        (2, "same WORDS here today", "en", "a", 1),
        (2, "same WORDS here today", "en", "a", 1),
        (9, None, None, None, None),
        (7, "  \n", "en", "b", 3),
        (None, "same words here today", "en", "b", 3),
        (None, "entirely different content of a text", "en", "b", 3),
        (11, long, "en", "b", 3),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(1)).withColumn("component", F.lit("x"))
    found = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    comps = [(r[0], r[2]) for r in found]
    assert comps.count((2, 2)) == 2 and (5, 2) in comps and (None, 2) in comps and (None, None) in comps
    assert (9, 7) in comps and (7, 7) in comps and (11, 11) in comps
    assert {r[1] for r in found if r[0] in (7, 9)} == {"0" * 16}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["11", "2", "7", "None"]


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0

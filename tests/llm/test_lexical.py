import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import lexical
from tallyline.llm.common import Stash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")]


def brute(docs, items, depth):
    """Rows of (item_id, rank, doc_id, score), sorted."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    held, words = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    made = []
    for ident, text in items:
        scored = []
        for doc, bag in bags:
            if bag:
                m = 10 + (90 * sum(bag.values()) * held) // words
                score = sum(
                    math.floor(1000 * math.log((2 * held + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in set(terms_of(text))
                    if bag[t]
                )
                if score > 0:
                    scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: s[:2] + ((s[2] or 0),))
        made += [(ident, k + 1, doc, -score) for k, (score, _, doc) in enumerate(scored[:depth])]
    return sorted(made, key=str)


def corpus(draw, n, common=("the", "of", "And"), rare=60):
    pick = lambda: draw.choice(common) if draw.random() < 0.5 else f"r{int(draw.paretovariate(0.8)) % rare}"
    return [" ".join(pick() for _ in range(draw.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("block_docs, depth, most", [(4, 10, 200_000), (64, 3, 25), (8192, 10, 200_000)])
def test_equals_brute_force(spark, monkeypatch, block_docs, depth, most):
    monkeypatch.setattr(lexical.index, "__defaults__", (block_docs,))
    monkeypatch.setattr(lexical.groups, "__defaults__", (most,))
    draw = random.Random(block_docs)
    texts = corpus(draw, 250)
    rows = list(enumerate(texts)) + [(3, texts[3]), (900, texts[3]), (None, texts[4]), (None, None), (901, ""), (902, "--- !"), (-9, "été Été ÉTÉ 日本 the")]
    rows.append((903, "the r1 " * 3000))
    items = list(enumerate(corpus(draw, 12))) + [(50, None), (51, ""), (52, "nowhere at all"), (53, "THE the of"), (54, "Été r5"), (None, "r3 r4"), (53, "r7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "score": F.lit(0), "rank": F.lit(1)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    made = lexical.ranked(docs.repartition(3), asked, depth)
    assert made.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows, items, depth)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs.withColumn("text", F.lit(None)), items).count() == 0
    assert lexical.ranked(docs, items).collect()[0][:3] == (1, 1, 1)


def test_text_ids_are_refused(spark):
    docs = spark.createDataFrame([("1", "a b")], "doc_id string, text string")
    with pytest.raises(ValueError, match="doc_id"):
        lexical.ranked(docs, docs.withColumn("item_id", F.lit(1)))


def arrays(spark, texts, queries):
    """The stored rows of one block, with the units of each query."""
    items = lexical.Items()
    for k, text in enumerate(queries):
        items.add(k, list(dict.fromkeys(t.encode() for t in terms_of(text))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    stash = Stash(spark)
    blocks = stash.put(lexical.index(docs, items.numbers), "postings")
    held, words, df = lexical.statistics(blocks, len(items.numbers))
    pairs, units = lexical.chosen_pairs(items, df)
    row = lexical.pair_lists(blocks, held, words, lexical.weights(held, df), pairs).collect()
    assert len(row) == 1
    return {name: np.array(row[0][name], np.int64) for name in row[0].asDict()}, pairs, units


def test_pair_lists_are_the_intersections(spark):
    row, pairs, units = arrays(spark, corpus(random.Random(5), 120), corpus(random.Random(6), 8))
    block = lexical.Block(row)
    assert pairs and any(pair >= 0 for mine in units for pair, *_ in mine)
    listed = set()
    for number, (a, b) in enumerate(pairs):
        sides = [dict(zip(*(v.tolist() for v in block.postings(t)), strict=True)) if t in block.term_at else {} for t in (a, b)]
        both = {d: sides[0][d] + sides[1][d] for d in sides[0].keys() & sides[1].keys()}
        if both:
            docs, joint = block.pair(number)
            assert dict(zip(docs.tolist(), joint.tolist(), strict=True)) == both
            assert block.peaks[block.pair_at[number]] == max(both.values())
            listed.add(number)
    assert listed == set(block.pair_at)


def test_bounds_hold_and_pairs_tighten_them(spark):
    """No document has more of a unit than its bound; some pair's bound is below the sum of its terms' maxima."""
    row, _, units = arrays(spark, corpus(random.Random(5), 120), corpus(random.Random(6), 8))
    block, tighter = lexical.Block(row), 0
    for pair, *terms in {unit for mine in units for unit in mine}:
        total = Counter()
        tops = 0
        for term in terms:
            if term in block.term_at:
                docs, impacts = block.postings(term)
                total.update(dict(zip(docs.tolist(), impacts.tolist(), strict=True)))
                tops += int(impacts.max())
        bound = block.bound((pair, *terms))
        assert bound == max(total.values(), default=0) <= tops or pair < 0
        tighter += bound < tops
    assert tighter


@pytest.mark.parametrize("quantile", [0.0, 0.5, 0.9, 1.0])
def test_threshold_leaves_out_only_what_is_below(spark, quantile):
    row, _, units = arrays(spark, corpus(random.Random(8), 200), corpus(random.Random(9), 6))
    block, scores = lexical.Block(row), np.zeros(len(row["ids"]), np.int64)
    for mine in units:
        at, value = lexical.best_of_block(block, mine, 0, 10, scores)
        every = dict(zip(at.tolist(), value.tolist(), strict=True))
        line = int(np.quantile(value, quantile))
        at, value = lexical.best_of_block(block, mine, line, 10, scores)
        assert dict(zip(at.tolist(), value.tolist(), strict=True)) == {d: v for d, v in every.items() if v >= line}
        assert not scores.any()

import random
import re

import pytest

from tallyline.llm import mixing
from tallyline.llm.common import Stash

DOCS = "doc_id long, text string, source string, n_chars long"


def plain_targets(sizes):
    """Deal out by weight, cap, deal the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(capped.values())
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 2.0 * sizes[s] for s in over}


def corpus(draw, sources, count):
    rows = []
    for i in range(count):
        source = draw.choice(sources)
        rows.append((i, draw.choice([" ", "\n", "\t "]).join("w" * draw.randint(1, 5) for _ in range(draw.choice([0, 1, 3, 30, 200]))), source, 0))
    return rows


def test_plan_equals_brute_force(spark):
    draw = random.Random(1)
    sources = ["big"] * 12 + ["b", "\U0001f600", "", "a", None, "z", "empty"]
    rows = [r if r[2] != "empty" else (r[0], None, "empty", 0) for r in corpus(draw, sources, 400)]
    docs = spark.createDataFrame(rows, DOCS)
    sizes, size = {}, {}
    for i, text, source, _ in rows:
        size[i] = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] = sizes.get(source, 0) + size[i]
    wanted = plain_targets(sizes)
    found = {}
    for pieces in (7, 1000):
        found[pieces] = {r["id"]: r for r in mixing.plan(docs, Stash(spark), piece_rows=pieces).collect()}
    assert found[7] == found[1000]
    taken = {}
    for i, _, source, _ in rows:
        r = found[7][i]
        assert r["size"] == size[i] and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(wanted[source]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 0.5 for s in sizes)


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 10, s, 0) for i, s in enumerate(["a", "b", "c"] * 200)]
    made = mixing.plan(spark.createDataFrame(rows, DOCS), Stash(spark)).collect()
    for source, knots in zip("abc", mixing.SCHEDULES.values(), strict=True):
        at = sorted(p for r in made if r["source"] == source for p in (r["first_position"], r["second_position"]) if p is not None)
        total = mixing._area(knots)
        half = sum(0 <= p < 0.5 for p in at) / len(at)
        mid = next(w for t, w in [*knots, (0.5, sum(w for _, w in knots) / len(knots))] if t == 0.5)
        expected = 0.5 * (knots[0][1] + mid) / 2 / total
        assert half == pytest.approx(expected, abs=0.02) and 0 <= at[0] and at[-1] <= 1


def test_in_order_returns_the_mix(spark):
    draw = random.Random(2)
    rows = corpus(draw, ["a"] * 5 + ["b", "c"], 120)
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_chars", "size")
    mix = mixing.in_order(docs, with_position=True)
    place = mix.columns[-1]
    got = mix.collect()
    assert mixing.in_order(docs).columns == docs.columns
    assert [r[place] for r in got] == sorted(r[place] for r in got)
    taken = {r["id"]: r["taken"] for r in mixing.plan(docs, Stash(spark)).collect()}
    words = {}
    for r in got:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {i: n for i, n in taken.items() if n}
    whole = {i: t for i, t, *_ in rows}
    parts = [r for r in got if r["text"] != whole[r["doc_id"]]]
    assert len(parts) <= 3 and all(whole[r["doc_id"]].split()[: len(r["text"].split())] == r["text"].split() for r in parts)


def test_edges(spark):
    rows = [(1, "a b c", "s", 5), (1, "a b c", "s", 5), (None, "d e", None, None), (None, "d e f", None, 1), (2, None, "t", 0), (3, "", "t", 0), (4, "w " * 30000, "u", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    made = mixing.plan(docs, Stash(spark)).collect()
    assert len(made) == 7 and sum(r["taken"] for r in made) == pytest.approx(1.5 * 30011, abs=4)
    assert mixing.in_order(docs).count() > 0
    none = spark.createDataFrame([], DOCS)
    assert mixing.plan(none, Stash(spark)).count() == 0 and mixing.in_order(none).count() == 0
    blank = spark.createDataFrame([(1, None, "s", 0), (2, " ", None, 0)], DOCS)
    assert [r["taken"] for r in mixing.plan(blank, Stash(spark)).collect()] == [0, 0]
    assert mixing.in_order(blank).count() == 0


def test_the_query_sorts_by_position(spark, tmp_path):
    from tallyline.llm.queries import QUERIES

    draw = random.Random(4)
    docs = spark.createDataFrame(corpus(draw, ["a"] * 5 + ["b", "c"], 300), DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    place = {r["id"]: (r["first_position"], r["second_position"]) for r in mixing.plan(docs, Stash(spark)).collect()}
    late = lambda p: (p is None, p or 0.0)
    got = [tuple(map(late, place[r["doc_id"]])) for r in QUERIES["op10_curriculum_mix"](spark, str(tmp_path)).collect()]
    assert len(got) == 300 and got == sorted(got) and len(set(got)) > 200
    plan = QUERIES["op10_curriculum_mix"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "first_position" in plan and "second_position" in plan

"""Operators against brute force, with ties, NULLs, hot keys and empty input."""

import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from tallyline.operators import clusters, counting, hops, keys, rates, stats, trailing


def test_grain_counts_skip_nulls_and_use_year_fallback(spark):
    rows = spark.createDataFrame(
        [("2024-02-29 23:10:00", None), ("2023-12-31 00:00:00", None), (None, 1999), (None, None)], "t string, y int"
    ).withColumn("t", F.col("t").cast("timestamp"))
    grains = counting.time_grains(F.col("t"), F.coalesce(F.year("t"), F.col("y")))
    got = {(r["trend_type"], r["trend_key"]): r["crime_count"] for r in counting.grain_counts(rows, grains).collect()}
    assert got == {
        ("year", "2024"): 1, ("year", "2023"): 1, ("year", "1999"): 1, ("month", "2024-02"): 1, ("month", "2023-12"): 1,
        ("day_of_week", "Thursday"): 1, ("day_of_week", "Sunday"): 1, ("hour", "23"): 1, ("hour", "00"): 1,
    }


def test_grain_counts_group_codes_before_texts(spark):
    """Texts are made above the last aggregate only."""
    rows = spark.range(10).select(F.timestamp_seconds("id").alias("t"))
    plan = counting.grain_counts(rows, counting.time_grains(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "format_string" not in below and "date_format" not in below


def test_roll_up_and_totals(spark):
    counts = spark.createDataFrame([("m1", "a", 2), ("m2", "a", 3), ("m1", "b", 4)], "m string, d string, n long")
    rolled = counting.roll_up(counts, ["m", "d"], ["d"], ["n"]).collect()
    assert sorted(map(tuple, rolled)) == [("ALL", "a", 5), ("ALL", "b", 4)]
    assert counting.positive_total(counts, ["n"]).first()["n"] == 9
    assert counting.positive_total(counts.where("n > 99"), ["n"]).count() == 0
    shares = counting.share_of_total(counts, "n", "s").collect()
    assert sum(r["s"] for r in shares) == pytest.approx(1.0)
    assert counting.share_of_total(counts.select(F.lit(0).alias("n")), "n", "s").first()["s"] == 0.0


def test_first_per_key_is_a_whole_row(spark):
    rows = [("k1", 2, "x"), ("k1", 1, "z"), ("k1", 1, "y"), (None, 5, "n"), ("k2", None, "q"), ("k2", 0, "r")]
    frame = spark.createDataFrame(rows, "k string, o int, v string")
    expected = {("k1", 1, "y"), (None, 5, "n"), ("k2", None, "q")}
    for parts in (1, 5):
        assert {tuple(r) for r in keys.first_per_key(frame.repartition(parts), ["k"], ["o"]).collect()} == expected


def test_hot_key_is_combined_on_the_map_side(spark):
    """A key with a third of all rows sends one row per task through the shuffle."""
    frame = spark.range(30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    for built in (
        keys.first_per_key(frame, ["k"]),
        keys.most_frequent(frame.withColumn("v", F.col("id") % 7), "k", "v"),
        trailing.per_second(frame.withColumn("t", F.timestamp_seconds(F.lit(5))), "k", "t", "id"),
    ):
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan and "Window" not in plan
    best = {r["k"]: r["id"] for r in keys.first_per_key(frame, ["k"]).collect()}
    assert best["hot"] == 0 and len(best) == 20001


def test_most_frequent_breaks_ties(spark):
    frame = spark.createDataFrame(
        [("b", "002"), ("b", "001"), ("c", "009"), ("c", "009"), ("c", "001"), (None, "001")], "k string, v string"
    )
    got = {r["k"]: (r["v"], r["n"]) for r in keys.most_frequent(frame, "k", "v", "n").collect()}
    assert got == {"b": ("001", 1), "c": ("009", 2)}


def test_rank_in_order(spark):
    frame = spark.range(1000, numPartitions=9).select((F.col("id") % 10).alias("n"), "id")
    got = keys.rank_in_order(frame, [F.desc("n"), F.asc("id")], "rank").collect()
    expected = sorted(((i % 10, i) for i in range(1000)), key=lambda p: (-p[0], p[1]))
    assert [(r["n"], r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))
    assert keys.rank_in_order(frame.where("id < 0"), [F.asc("id")], "rank").count() == 0


def test_rates_against_brute_force(spark):
    rnd = random.Random(3)
    cases = [(f"C{i}", rnd.choice("AB"), rnd.choice(["001", "002"])) for i in range(200)]
    hits = [(f"C{rnd.randrange(260)}", rnd.choice("XYZ")) for _ in range(400)]
    case_frame = spark.createDataFrame(cases, "case_number string, primary_type string, district string")
    hit_frame = spark.createDataFrame(hits, "case_number string, race string")
    tally = rates.outcome_tally(case_frame, hit_frame, "case_number", ["primary_type", "district"], "race")

    groups = {c: (t, d) for c, t, d in cases}
    base = Counter(groups.values())
    found = Counter((*groups[c], r) for c, r in set(hits) if c in groups)
    detail = rates.rate_detail(tally, ["primary_type", "district"], "race").collect()
    assert {(r[0], r[1], r[2]): (r[3], r[4]) for r in detail} == {k: (base[k[:2]], n) for k, n in found.items()}
    assert all(r["arrest_rate"] == pytest.approx(r["total_arrests"] / r["total_crimes"]) for r in detail)

    any_hit = {c for c, _ in hits}
    whole = {r[0]: (r[1], r[2]) for r in rates.rate_of(tally, "primary_type").collect()}
    for kind in "AB":
        mine = [c for c, t, _ in cases if t == kind]
        assert whole[kind] == (len(mine), sum(c in any_hit for c in mine))


def test_rate_of_a_type_without_outcome_is_zero(spark):
    cases = spark.createDataFrame([("1", "A", "d")], "case_number string, primary_type string, district string")
    none = spark.createDataFrame([], "case_number string, race string")
    tally = rates.outcome_tally(cases, none, "case_number", ["primary_type", "district"], "race")
    assert tuple(rates.rate_of(tally, "primary_type").first()) == ("A", 1, 0, 0.0)
    assert rates.rate_detail(tally, ["primary_type", "district"], "race").count() == 0


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([], 0.0),
        ([(1.0, 2.0)], 0.0),
        ([(1.0, 2.0), (1.0, 3.0)], 0.0),
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
        ([(1.0, 2.0), (2.0, 1.0), (5.0, None), (None, 9.0)], -1.0),
        ([(0.1, 1.0)] * 3, 0.0),
    ],
)
def test_pearson(spark, rows, expected):
    frame = spark.createDataFrame(rows, "x double, y double")
    assert frame.agg(stats.pearson(F.col("x"), F.col("y"))).first()[0] == pytest.approx(expected)


def test_hop_counts_equal_window(spark):
    frame = spark.range(400).select(
        (F.col("id") % 3).cast("string").alias("k"), F.timestamp_seconds(F.col("id") * 37 % 5000).alias("t")
    )
    for size, slide in ((300, 60), (300, 300), (100, 40), (60, 90)):
        ours = hops.hop_counts(frame, "k", "t", size, slide)
        if slide <= size:
            w = F.window("t", f"{size} seconds", f"{slide} seconds")
            theirs = frame.groupBy("k", w.alias("w")).count().select("k", "w.start", "w.end", "count")
            assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0
        else:
            inside = frame.where(F.unix_seconds("t") % slide < size).count()
            assert ours.agg(F.sum("event_count")).first()[0] == inside


def simulated_emits(rows, size, slide):
    """Row by row, with one queue per key."""
    out, state = [], {}
    for key, t, ident in rows:
        queue, last = state.setdefault(key, (deque(), [None]))
        queue.append(t)
        while queue[0] < t - size:
            queue.popleft()
        if last[0] is None or t - last[0] >= slide:
            last[0] = t
            out.append((key, t - size, t, ident, len(queue)))
    return sorted(out)


def event_frame(spark, rows):
    frame = spark.createDataFrame(rows, "k string, s long, id long")
    return frame.withColumn("t", F.timestamp_seconds("s"))


def test_stated_emits(spark):
    rows = [("k", t, i) for i, t in enumerate([1000, 1030, 1060, 1300, 1361])]
    seconds = trailing.per_second(event_frame(spark, rows), "k", "t", "id")
    got = sorted(tuple(r) for r in trailing.trailing_emits(seconds, 300, 60).collect())
    assert [(e[2], e[4]) for e in got] == [(1000, 1), (1060, 3), (1300, 4), (1361, 2)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk", [10, 64, 100000])
def test_emits_against_simulation(spark, seed, chunk):
    rnd = random.Random(seed)
    size, slide = [(20, 6), (5, 9), (30, 1)][seed]
    rows = []
    for key, steps in (("hot", [0, 0, 0, 1]), ("mid", [0, 1, 5, 9]), ("rare", [40, 90, 300])):
        now = rnd.randrange(50)
        for _ in range(600 if key == "hot" else 150):
            now += rnd.choice(steps)
            rows.append((key, now, len(rows)))
    seconds = trailing.per_second(event_frame(spark, rows).repartition(3), "k", "t", "id")
    got = sorted(tuple(r) for r in trailing.trailing_emits(seconds, size, slide, chunk).collect())
    assert got == simulated_emits(rows, size, slide)


def test_emits_of_nothing_and_of_text_ids(spark):
    rows = [("k", 5, 1), ("k", 5, 0), (None, 6, 2), ("k", None, 3)]
    frame = event_frame(spark, rows).withColumn("id", F.format_string("id-%d", "id"))
    seconds = trailing.per_second(frame, "k", "t", "id")
    assert [tuple(r) for r in trailing.trailing_emits(seconds, 300, 60).collect()] == [("k", -295, 5, "id-0", 1)]
    assert trailing.trailing_emits(seconds.where("t < 0"), 300, 60).count() == 0
    with pytest.raises(ValueError, match="at least one second"):
        trailing.trailing_emits(seconds, 300, 0)


def test_trailing_counts_do_not_depend_on_chunks(spark):
    rows = [("k", t, t) for t in range(0, 500, 3)]
    seconds = trailing.per_second(event_frame(spark, rows), "k", "t", "id")
    one = {(r["t"], r["event_count"]) for r in trailing.trailing_counts(seconds, 60, 10**6).collect()}
    many = {(r["t"], r["event_count"]) for r in trailing.trailing_counts(seconds, 60, 61).collect()}
    assert one == many == {(t, 1 + sum(t - 60 <= s < t for s in range(0, 500, 3))) for t in range(0, 500, 3)}


def test_nearest_center(spark):
    points = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (1.0, 0.0)], "latitude double, longitude double")
    centers = spark.createDataFrame([(7, 0.0, 0.0), (3, 2.0, 0.0), (9, 6.0, 6.0)], "id int, x double, y double")
    got = [r["cluster_id"] for r in clusters.nearest_center(points, centers, 5).collect()]
    assert got == [7, 9, 3]
    with pytest.raises(Exception, match="more than 2 centers"):
        clusters.nearest_center(points, centers, 2).collect()


def test_hotspots(spark):
    spots = [(41.0, -87.0)] * 30 + [(42.0, -88.0)] * 20 + [(0.0, -88.0), (41.0, 0.0), (None, 1.0)]
    frame = spark.createDataFrame(spots, "a double, b double")
    points = clusters.valid_points(frame, F.col("a"), F.col("b"))
    found = clusters.hotspots(points, k=2).collect()
    assert sorted((round(r[1], 6), round(r[2], 6), r[3]) for r in found) == [(41.0, -87.0, 30), (42.0, -88.0, 20)]
    assert sum(r["crime_count"] for r in clusters.hotspots(points, k=10).collect()) == points.count()
    empty = clusters.hotspots(points.where("latitude > 90"), k=3)
    assert empty.columns == ["cluster_id", "centroid_latitude", "centroid_longitude", "crime_count"] and empty.count() == 0
    assert len(clusters.hotspots(points.limit(1), k=10).collect()) == 1


def test_hotspots_do_not_depend_on_partitioning(spark):
    """Bit-equal centers for any order of rows, number of partitions and split of equal points."""
    import random

    draw = random.Random(3)
    rows = [(41 + draw.gauss(0, 0.2), -87 + draw.gauss(0, 0.3)) for _ in range(400)] + [(-3.5, 100.25)] * 200
    found = []
    for parts in (1, 3, 16):
        draw.shuffle(rows)
        points = spark.createDataFrame(rows, "latitude double, longitude double").repartition(parts)
        found.append([tuple(r) for r in clusters.hotspots(points, k=5).collect()])
    assert found[0] == found[1] == found[2] and len(found[0]) == 5
    assert sum(r[3] for r in found[0]) == 600
    again = [tuple(r) for r in clusters.hotspots(points, k=5, seed=43).collect()]
    assert again[0][1:3] != found[0][0][1:3] or again != found[0]


def test_hotspots_against_plain_steps(spark):
    """The same fit, step by step in plain Python."""
    import hashlib
    import math
    import random

    draw = random.Random(9)
    rows = [(round(draw.uniform(-2, 2), 1) or 0.1, round(draw.uniform(-2, 2), 1) or 0.1) for _ in range(150)]
    places = {}
    for x, y in rows:
        key = (round(x * 1_000_000), round(y * 1_000_000))
        places[key] = places.get(key, 0) + 1
    gap = lambda p, c: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2
    centers = []
    for step in range(6):
        race = []
        for p, w in places.items():
            chance = w * min((gap(p, c) for c in centers), default=1)
            if chance:
                u = (int(hashlib.md5(f"42:{step}:{p[0]}:{p[1]}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
                race.append((-math.log(u) / chance, p))
        centers.append(min(race)[1])
    while True:
        sums = [[0, 0, 0] for _ in centers]
        for p, w in places.items():
            best = min(range(len(centers)), key=lambda i: (gap(p, centers[i]), i))
            sums[best] = [sums[best][0] + w * p[0], sums[best][1] + w * p[1], sums[best][2] + w]
        moved = [tuple((2 * s[k] + s[2]) // (2 * s[2]) for k in (0, 1)) if s[2] else c for s, c in zip(sums, centers, strict=True)]
        if moved == centers:
            break
        centers = moved
    wanted = [(i, c[0] / 1_000_000, c[1] / 1_000_000, s[2]) for i, (c, s) in enumerate(zip(centers, sums, strict=True))]
    points = spark.createDataFrame(rows, "latitude double, longitude double")
    assert [tuple(r) for r in clusters.hotspots(points, k=6).collect()] == wanted


def test_mllib_fit_stays(spark):
    points = spark.createDataFrame([(41.0, -87.0)] * 3 + [(42.0, -88.0)], "latitude double, longitude double")
    assert sorted(r["crime_count"] for r in clusters.mllib_hotspots(points, k=2).collect()) == [1, 3]

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import vectors

ROWS = "vec_id long, embedding array<float>, label int"


def planted(seed, count=500, width=16, copies=200):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((8, width)) * 1.5
    base = centres[draw.integers(0, 8, count)] + draw.standard_normal((count, width))
    near = base[draw.integers(0, count, copies)]
    near = near + draw.standard_normal(near.shape) * np.linalg.norm(near, axis=1, keepdims=True) * draw.uniform(0, 0.12, (copies, 1))
    same = base[draw.integers(0, count, 40)]
    hot = np.repeat(base[:1], 60, axis=0)
    return np.concatenate([base, near, same, hot]).astype(np.float32)


def brute(values):
    x = values.astype(np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = x @ x.T >= vectors.LIMIT
    np.fill_diagonal(hits, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(hits, label[None, :], len(x)).min(axis=1, initial=len(x)))
        if np.array_equal(new, label):
            return hits.sum(axis=1), label
        label = new


def test_walk_is_in_order_and_complete():
    draw = np.random.default_rng(1)
    for _ in range(20):
        a, b = draw.random(7) ** 2, draw.random(9) ** 2
        found = list(vectors.walk(a, b, 0.5))
        wanted = sorted((a[i] + b[j], i, j) for i in range(7) for j in range(9) if a[i] + b[j] <= 0.5)
        assert [f[0] for f in found] == [w[0] for w in wanted]
        assert {f[1:] for f in found} == {w[1:] for w in wanted}


def test_cell_distance_is_a_lower_bound():
    units = vectors.unit_rows(planted(2))
    index = vectors.build(units, len(units))
    a, b, homes = index.distances(units)
    gaps = ((units[:, None, :] - units[None, :80, :]) ** 2).sum(axis=2)
    seen = a[:, homes[:80] // len(index.second)] + b[:, homes[:80] % len(index.second)]
    assert (seen <= gaps + 1e-9).all()


def test_query_against_brute_force(spark):
    values = planted(3)
    frame = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(values)], ROWS)
    links, labels = brute(values)
    for cell_rows in (1024, 16):
        got = {r["vec_id"]: r for r in vectors.near_duplicates(frame, cell_rows=cell_rows).collect()}
        found = np.array([got[i]["n_links"] for i in range(len(values))])
        assert len(got) == len(values) and (found <= links).all()
        assert found.sum() >= 0.99 * links.sum()
        comps = np.array([got[i]["component_id"] for i in range(len(values))])
        assert (comps == labels).mean() >= 0.99
        assert all(got[i]["kept"] == (comps[i] == i) for i in range(len(values)))


def test_all_cells_give_all_links(spark):
    values = planted(4, 200, 12, 150)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(values)], ROWS)
    links, labels = brute(values)
    got = {r["vec_id"]: r for r in vectors.near_duplicates(frame, target=1.0, cell_rows=8).collect()}
    assert sum(got[i]["n_links"] for i in range(len(values))) >= 0.999 * links.sum()
    assert np.mean([got[i]["component_id"] == labels[i] for i in range(len(values))]) >= 0.999


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, v, 0), (2, [2.0, 4.0, 6.0, 8.0], 0), (2, [-1.0, 0.0, 0.0, 0.0], 0), (3, None, 0), (4, [0.0] * 4, 0), (5, [1.0, None, 2.0, 3.0], 0),
        (6, [nan, 1.0, 1.0, 1.0], 0), (7, [inf, 1.0, 1.0, 1.0], 0), (8, [1.0, 2.0, 3.0], 0), (9, [1.0, 2.0, 3.0], 0), (None, v, None),
        (None, [5.0, -5.0, 5.0, -5.0], 1), (10, [], 0), (11, [7.0], 0),
    ]
    frame = spark.createDataFrame(rows, ROWS).withColumn("node", F.lit(1)).withColumn("n", F.lit(2))
    got = sorted(map(tuple, vectors.near_duplicates(frame).collect()), key=str)
    wanted = [
        (1, 2, 1, True), (2, 2, 1, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
        (8, 1, 8, True), (9, 1, 8, False), (None, 2, 1, False), (None, 0, None, True), (10, 0, 10, True), (11, 0, 11, True),
    ]
    assert got == sorted(wanted, key=str)
    assert vectors.near_duplicates(spark.createDataFrame([], ROWS)).count() == 0

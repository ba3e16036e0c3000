import random

from tallyline.llm.common import Stash
from tallyline.llm.components import components


def test_chains_stars_and_repeats(spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7, 6)]
    links += [(2000 + draw.randrange(80), 2000 + draw.randrange(80)) for _ in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    names = list(parent)
    draw.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long"), Stash(spark)).collect()
    assert {r["node"]: r["label"] for r in found} == {x: find(x) for x in names}
    assert len(found) == len(names)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Stash(spark)).count() == 0

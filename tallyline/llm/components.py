"""Connected components of a link table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import Stash


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 2**31).alias("h")).first()
    return row["n"], row["h"] or 0


def components(links: DataFrame, stash: Stash) -> DataFrame:
    """``(node, label)`` for each node that has a link; label is the smallest node reached.

    ``links`` has two long columns ``a`` and ``b``. Large-star and small-star steps
    (each node's larger neighbours, then its smaller ones, are hung on the smallest
    neighbour) alternate until no link changes; only a count and a checksum come to
    the driver. A node with very many links is aggregated with a map-side part and
    joined from stored frames, which Spark splits when they are skewed.
    """
    edges = stash.put(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stash.put(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "near"
        )
        large = stash.put(
            both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large"
        )
        lower = stash.put(large.groupBy("a").agg(F.min("b").alias("m")), "lower")
        rest = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stash.put(lower.select("a", F.col("m").alias("b")).unionByName(rest).distinct(), "small")
        stash.drop(edges, near, large, lower)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )

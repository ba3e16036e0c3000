"""Hotspots: K-Means on distinct weighted points, and nearest centers.

The fit works in whole numbers: coordinates count in steps of ``1 / scale``, so sums are
exact and do not depend on the order of rows. Seeding draws by hash, not by a generator
that partitions share. Centers are thus the same, bit for bit, for any partitioning,
number of executors and rerun.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.values import finite
from tallyline.session import materialise

HOTSPOT_SCHEMA = "cluster_id int, centroid_latitude double, centroid_longitude double, crime_count long"
SCALE = 1_000_000
MOST_STEPS = 100


def valid_points(df: DataFrame, x: Column, y: Column, names: tuple[str, str] = ("latitude", "longitude")) -> DataFrame:
    """Points with both coordinates present and finite, and neither zero."""
    points = df.select(x.cast("double").alias(names[0]), y.cast("double").alias(names[1]))
    return points.where((F.col(names[0]) != 0.0) & (F.col(names[1]) != 0.0) & finite(F.col(names[0])) & finite(F.col(names[1])))


def _gaps(places: DataFrame, centers: list[tuple[int, int]]) -> list[Column]:
    """Squared distance to each center, a whole number."""
    x, y = F.col(places.columns[0]), F.col(places.columns[1])
    return [(x - F.lit(a)) * (x - F.lit(a)) + (y - F.lit(b)) * (y - F.lit(b)) for a, b in centers]


def _draw(seed: int, step: int, x: Column, y: Column) -> Column:
    """A number between 0 and 1 from a hash of the seed, the step and the place."""
    text = F.concat_ws(":", F.lit(f"{seed}:{step}"), x.cast("string"), y.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)


def seed_centers(places: DataFrame, k: int, seed: int) -> list[tuple[int, int]]:
    """Up to ``k`` distinct places (x, y, weight), each drawn with a chance in proportion
    to its weight times its squared distance to those drawn before.

    The place with the least ``-ln(u) / chance`` wins, a draw that is one ``min`` over
    all places, so it needs no running total and no order of rows.
    """
    x, y, weight = (F.col(c) for c in places.columns)
    centers: list[tuple[int, int]] = []
    while len(centers) < k:
        chance = weight.cast("double")
        left = places
        if centers:
            left = places.withColumn("gap_", F.array_min(F.array(*_gaps(places, centers)))).where(F.col("gap_") > 0)
            chance = (weight * F.col("gap_").cast("decimal(38,0)")).cast("double")
        race = F.struct((-F.log(_draw(seed, len(centers), x, y)) / chance).alias("s"), x.alias("x"), y.alias("y"))
        best = left.agg(F.min(race).alias("best")).first()["best"]
        if best is None:
            break
        centers.append((best["x"], best["y"]))
    return centers


def _members(places: DataFrame, centers: list[tuple[int, int]]) -> dict[int, tuple[int, int, int]]:
    """Exact sums of x, y and weight of the places nearest to each center; the lower number wins a tie."""
    x, y, weight = places.columns
    measured = places.withColumn("gaps_", F.array(*_gaps(places, centers)))
    number = (F.array_position("gaps_", F.array_min("gaps_")) - 1).cast("int")
    total = lambda c: F.sum((F.col(c) * F.col(weight)).cast("decimal(38,0)")).alias(c)
    sums = measured.groupBy(number.alias("number")).agg(total(x), total(y), F.sum(weight).alias(weight))
    return {row["number"]: (int(row[x]), int(row[y]), row[weight]) for row in sums.collect()}


def hotspots(points: DataFrame, k: int = 10, seed: int = 42, scale: int = SCALE, most_steps: int = MOST_STEPS) -> DataFrame:
    """Centers and member counts; an empty typed result when there are no points.

    Equal points (to ``1 / scale``) are merged into one weighted point first. The fit
    then makes its passes over distinct places instead of over all rows, and the merge
    happens on the map side, however many rows share a place. Steps end when no center
    moves, or after ``most_steps``; a center is the mean of its members rounded half up to
    ``1 / scale``. With fewer than ``k`` places each is a center. Only k rows of sums reach
    the driver in a step.
    """
    spark = points.sparkSession
    placed = points.select(*(F.round(F.col(c) * scale).cast("long").alias(n) for c, n in zip(points.columns, "xy", strict=True)))
    places = materialise(placed.groupBy("x", "y").agg(F.count(F.lit(1)).alias("weight")))
    centers = seed_centers(places, max(1, int(k)), seed)
    if not centers:
        return spark.createDataFrame([], HOTSPOT_SCHEMA)
    for _ in range(most_steps):
        sums = _members(places, centers)
        moved = [((2 * sums[i][0] + sums[i][2]) // (2 * sums[i][2]), (2 * sums[i][1] + sums[i][2]) // (2 * sums[i][2])) if i in sums else c for i, c in enumerate(centers)]
        if moved == centers:
            break
        centers = moved
    else:
        sums = _members(places, centers)
    rows = [(i, x / scale, y / scale, sums[i][2] if i in sums else 0) for i, (x, y) in enumerate(centers)]
    return spark.createDataFrame(rows, HOTSPOT_SCHEMA)


def mllib_hotspots(points: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """The fit by MLlib: fewer passes for a large k, but its centers depend on the partitioning.

    Equal points are merged into one weighted point first. The fit then makes its
    passes over distinct places instead of over all rows, and the merge happens on
    the map side, however many rows share a place.
    """
    spark = points.sparkSession
    x, y = points.columns
    weighted = materialise(points.groupBy(x, y).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    rows = int(weighted.agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("n")).first()["n"])
    if rows == 0:
        return spark.createDataFrame([], HOTSPOT_SCHEMA)
    clusters = max(1, min(int(k), rows))
    if clusters == 1:  # MLlib fits two or more; the best single center is the mean.
        mean = [(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")) for c in (x, y)]
        return weighted.agg(
            F.lit(0).alias("cluster_id"),
            mean[0].alias("centroid_latitude"),
            mean[1].alias("centroid_longitude"),
            F.sum("weight").cast("long").alias("crime_count"),
        )
    features = VectorAssembler(inputCols=[x, y], outputCol="features").transform(weighted)
    model = KMeans(
        k=clusters, seed=seed, featuresCol="features", predictionCol="cluster_id", weightCol="weight"
    ).fit(features)
    members = (
        model.transform(features).groupBy("cluster_id").agg(F.sum("weight").cast("long").alias("crime_count"))
    )
    centers = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    placed = spark.createDataFrame(centers, "cluster_id int, centroid_latitude double, centroid_longitude double")
    return placed.join(members, "cluster_id", "left").fillna({"crime_count": 0})


def nearest_center(points: DataFrame, centers: DataFrame, k: int, name: str = "cluster_id") -> DataFrame:
    """The closest of at most ``k`` centers (id, x, y) for every point.

    The centers come in as one scalar subquery and are compared inside the
    projection, so the points are neither joined nor shuffled. The lower id wins
    a tie.
    """
    x, y = points.columns[:2]
    cid, cx, cy = centers.columns
    center = F.struct(F.col(cid).alias("id"), F.col(cx).alias("x"), F.col(cy).alias("y"))
    packed = centers.limit(k + 1).agg(F.sort_array(F.collect_list(center)).alias("c")).select(
        F.when(F.size("c") <= k, F.col("c")).otherwise(F.raise_error(F.lit(f"more than {k} centers"))).alias("c")
    )

    def gap(c: Column) -> Column:
        across, up = F.col(x) - c["x"], F.col(y) - c["y"]
        return across * across + up * up

    # One list per point: a chain of comparisons of single numbers grows past what Spark compiles.
    measured = points.withColumn("centers_", packed.scalar()).withColumn("gaps_", F.transform("centers_", gap))
    nearest = (F.array_position("gaps_", F.array_min("gaps_")) - 1).cast("int")
    return measured.select(*points.columns, F.get("centers_", nearest)["id"].alias(name))

"""The analytics and their operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.bindings.registry import query
from tallyline.bindings.scalars import HOPS
from tallyline.bindings.tables import (
    BLOCKS, DIMENSION, INCIDENTS, OUTCOMES, REGISTRY, SIZE, SLIDE, VICTIM_KEYWORD, VICTIMS, block_incidents, dimension,
    event_incidents, incidents, order_moments, outcomes, registry, stamp, table, victims,
)
from tallyline.operators import clusters, counting, hops, keys, rates, trailing
from tallyline.operators.stats import correlation_rows
from tallyline.plans import correlations, density, outcomes as outcome_plan
from tallyline.plans import incidents as incident_plan
from tallyline.plans.trends import crime_trends
from tallyline.session import materialise


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, as in the oracle."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def trends_sql(source: str, moment: str) -> str:
    return f"""
    SELECT trend_type, trend_key, count(*) AS crime_count FROM (
        SELECT 'year' AS trend_type, CAST(year({moment}) AS VARCHAR) AS trend_key FROM {source}
        UNION ALL SELECT 'month', strftime({moment}, '%Y-%m') FROM {source}
        UNION ALL SELECT 'day_of_week', dayname({moment}) FROM {source}
        UNION ALL SELECT 'hour', strftime({moment}, '%H') FROM {source})
    WHERE trend_key IS NOT NULL GROUP BY 1, 2
    """


@query("trend_counts", trends_sql("orders", "o_orderdate"))
def trend_counts(spark: SparkSession, folder: str) -> DataFrame:
    return crime_trends(order_moments(spark, folder))


@query("trend_counts_events", trends_sql("events", "ts"))
def trend_counts_events(spark: SparkSession, folder: str) -> DataFrame:
    return crime_trends(event_incidents(spark, folder), year=None)


@query(
    "key_counts",
    "SELECT event_type AS trend_key, count(*) AS crime_count FROM events WHERE trim(event_type) <> '' GROUP BY 1",
)
def key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counting.key_counts(table(spark, folder, "events"), F.col("event_type"), "trend_key", "crime_count")


RATES = f"""
    cases AS ({INCIDENTS}), hits AS (SELECT DISTINCT case_number, race FROM ({OUTCOMES})),
    base AS (SELECT primary_type, district, count(*) AS total_crimes FROM cases GROUP BY 1, 2),
    detail AS (
        SELECT primary_type, district, race, total_crimes, total_arrests,
               round(total_arrests / total_crimes, 6) AS arrest_rate
        FROM (SELECT primary_type, district, race, count(DISTINCT case_number) AS total_arrests
              FROM cases JOIN hits USING (case_number) GROUP BY 1, 2, 3) JOIN base USING (primary_type, district)),
    tops AS (
        SELECT primary_type, total_crimes, total_arrests, round(total_arrests / total_crimes, 6) AS arrest_rate
        FROM (SELECT primary_type, count(*) AS total_crimes,
                     count(*) FILTER (WHERE case_number IN (SELECT case_number FROM hits)) AS total_arrests
              FROM cases GROUP BY 1)
        ORDER BY total_arrests / total_crimes DESC, total_crimes DESC, primary_type LIMIT 10)
"""
RATE_ROWS = f"""
    WITH {RATES}
    SELECT * FROM detail
    UNION ALL SELECT primary_type, 'ALL', 'ALL', total_crimes, total_arrests, arrest_rate FROM tops
"""


def tally(spark: SparkSession, folder: str) -> DataFrame:
    return outcome_plan.case_tally(incidents(spark, folder), outcomes(spark, folder))


@query("rate_by_group", f"WITH {RATES} SELECT * FROM detail")
def rate_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rates.rate_detail(tally(spark, folder), outcome_plan.GROUPS, outcome_plan.KIND), "arrest_rate")


@query("rate_topk", f"WITH {RATES} SELECT * FROM tops")
def rate_topk(spark: SparkSession, folder: str) -> DataFrame:
    best = rates.best_rates(rates.rate_of(tally(spark, folder), "primary_type"), "primary_type", 10)
    return rounded(best, "arrest_rate")


@query(
    "rows_with_match",
    f"SELECT case_number, district FROM ({INCIDENTS}) WHERE case_number IN (SELECT case_number FROM ({OUTCOMES}))",
)
def rows_with_match(spark: SparkSession, folder: str) -> DataFrame:
    cases = incidents(spark, folder).select("case_number", "district")
    return keys.rows_with_match(cases, outcomes(spark, folder), "case_number")


@query("outcome_rates", RATE_ROWS)
def outcome_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(outcome_plan.arrest_rates(tally(spark, folder)), "arrest_rate")


def _stats_sql(month: str, district: str, community: str, grouping: str) -> str:
    return f"""
    SELECT {month} AS month, {district} AS district, {community} AS community_area,
           count(*) FILTER (WHERE is_homicide) AS total_homicides,
           count(*) FILTER (WHERE is_gunshot AND NOT is_homicide) AS total_nonfatal_shootings,
           count(*) FILTER (WHERE is_gunshot) AS gunshot_incidents, count(*) AS total_incidents,
           round(count(*) FILTER (WHERE is_gunshot) / count(*), 6) AS gunshot_proportion
    FROM ({VICTIMS}) GROUP BY {grouping}
    """


STATS_DETAIL = _stats_sql("month", "district", "community_area", "month, district, community_area")
STATS_TOP = (
    _stats_sql("'ALL'", "'ALL'", "community_area", "community_area")
    + " ORDER BY total_incidents DESC, community_area LIMIT 20"
)


@query("incident_stats", f"SELECT * FROM ({STATS_DETAIL}) UNION ALL SELECT * FROM ({STATS_TOP})")
def incident_stats(spark: SparkSession, folder: str) -> DataFrame:
    detail = incident_plan.detail_counts(victims(spark, folder), VICTIM_KEYWORD)
    return rounded(incident_plan.violence_stats(detail), "gunshot_proportion")


@query("incident_topk", STATS_TOP)
def incident_topk(spark: SparkSession, folder: str) -> DataFrame:
    detail = incident_plan.detail_counts(victims(spark, folder), VICTIM_KEYWORD)
    return rounded(incident_plan.with_proportion(incident_plan.top_communities(detail)), "gunshot_proportion")


MODES = f"""
    modes AS (
        SELECT block_key, district FROM (
            SELECT block_key, district, row_number() OVER (PARTITION BY block_key ORDER BY count(*) DESC, district) AS rn
            FROM ({BLOCKS}) GROUP BY block_key, district)
        WHERE rn = 1)
"""


@query("mode_per_group", f"WITH {MODES} SELECT * FROM modes")
def mode_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return density.block_areas(block_incidents(spark, folder))


DENSITY = f"""
    {MODES}, counts AS (
        SELECT district, count(*) AS offender_count, CAST(sum(minor) AS BIGINT) AS victim_minor_count
        FROM ({REGISTRY}) LEFT JOIN modes USING (block_key) GROUP BY district),
    density AS (
        SELECT district, COALESCE(district_name, 'District name unavailable') AS district_name, offender_count,
               victim_minor_count,
               CAST(row_number() OVER (ORDER BY offender_count DESC, district) AS INTEGER) AS density_rank
        FROM counts LEFT JOIN ({DIMENSION}) USING (district) WHERE district IS NOT NULL
        UNION ALL
        SELECT 'UNMATCHED', 'No district match from block-level approximation', offender_count, victim_minor_count, NULL
        FROM counts WHERE district IS NULL)
"""


def density_rows(spark: SparkSession, folder: str) -> DataFrame:
    return density.sex_offender_density(
        registry(spark, folder), dimension(spark, folder), block_incidents(spark, folder)
    )


def offender_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Offenders per area, unranked."""
    return density.area_counts(registry(spark, folder), block_incidents(spark, folder))


@query("derived_key_counts", f"WITH {DENSITY} SELECT * FROM density")
def derived_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return density_rows(spark, folder)


METRICS = f"""
    area_cases AS (
        SELECT district, count(*) AS total_crimes,
               count(*) FILTER (WHERE case_number IN (SELECT case_number FROM ({OUTCOMES}))) AS total_arrests
        FROM ({INCIDENTS}) GROUP BY 1),
    metrics AS (
        SELECT district, total_crimes, total_arrests, COALESCE(total_violence, 0) AS total_violence,
               COALESCE(total_violence, 0) / total_crimes AS violence_rate, total_arrests / total_crimes AS arrest_rate
        FROM area_cases LEFT JOIN (SELECT district, count(*) AS total_violence FROM ({VICTIMS}) GROUP BY 1) USING (district))
"""


def violence(spark: SparkSession, folder: str) -> DataFrame:
    return counting.key_counts(victims(spark, folder), F.col("district"), "district", "total_violence")


@query(
    "metric_by_key",
    f"""WITH {METRICS} SELECT district, total_crimes, total_arrests, total_violence,
        round(violence_rate, 6) AS violence_rate, round(arrest_rate, 6) AS arrest_rate FROM metrics""",
)
def metric_by_key(spark: SparkSession, folder: str) -> DataFrame:
    cases = rates.rate_of(tally(spark, folder), "district")
    return rounded(correlations.area_metrics(cases, violence(spark, folder)), "violence_rate", "arrest_rate")


@query(
    "share_of_total",
    f"""SELECT district, count(*) AS total_crimes, round(count(*) / (SELECT count(*) FROM orders), 6) AS crime_rate
        FROM ({INCIDENTS}) GROUP BY 1""",
)
def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    counts = counting.key_counts(incidents(spark, folder), F.col("district"), "district", "total_crimes")
    return rounded(counting.share_of_total(counts, "total_crimes", "crime_rate"), "crime_rate")


def _corr_sql(name: str, x: str, y: str, source: str) -> str:
    """Same mapping of odd cases to zero as the operator."""
    return f"""
    SELECT '{name}' AS correlation_name, district AS grouping_key, '{x}' AS x_metric, '{y}' AS y_metric,
           round({x}, 6) AS x_value, round({y}, 6) AS y_value,
           round(COALESCE((SELECT CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN 0.0
                                  ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END FROM {source}), 0.0), 6)
               AS correlation_value
    FROM {source}
    """


CORRELATIONS = f"""
    WITH {METRICS}, {DENSITY},
    offender AS (
        SELECT d.district, CAST(offender_count AS DOUBLE) AS offender_density,
               COALESCE(total_crimes, 0) / (SELECT sum(total_crimes) FROM area_cases) AS crime_rate
        FROM density d LEFT JOIN area_cases USING (district) WHERE d.district <> 'UNMATCHED')
    {_corr_sql(correlations.VIOLENCE_ARREST, 'violence_rate', 'arrest_rate', 'metrics')}
    UNION ALL {_corr_sql(correlations.OFFENDER_CRIME, 'offender_density', 'crime_rate', 'offender')}
"""


@query("metric_correlation", CORRELATIONS)
def metric_correlation(spark: SparkSession, folder: str) -> DataFrame:
    found = correlations.correlations(tally(spark, folder), violence(spark, folder), offender_areas(spark, folder))
    return rounded(found, "x_value", "y_value", "correlation_value")


@query(
    "correlation_of_rows",
    """
    SELECT 'quantity_vs_price' AS correlation_name, CAST(l_orderkey AS VARCHAR) AS grouping_key, 'l_quantity' AS x_metric,
           'l_extendedprice' AS y_metric, l_quantity AS x_value, l_extendedprice AS y_value,
           round((SELECT corr(l_quantity, l_extendedprice) FROM lineitem), 6) AS correlation_value
    FROM lineitem
    """,
)
def correlation_of_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn("key", F.col("l_orderkey").cast("string"))
    return rounded(correlation_rows(lines, "quantity_vs_price", "key", "l_quantity", "l_extendedprice"), "correlation_value")


@query(
    "dedupe_key",
    """
    SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_quantity FROM (
        SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, l_linenumber, l_partkey, l_quantity,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_quantity) AS rn
        FROM lineitem) WHERE rn = 1
    """,
)
def dedupe_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_quantity")
    return keys.first_per_key(lines, ["l_orderkey"], ["l_shipdate"]).withColumn("l_shipdate", stamp("l_shipdate"))


@query(
    "rank_in_order",
    """
    SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS place
    FROM orders GROUP BY o_custkey
    """,
)
def rank_in_order(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return keys.rank_in_order(counts, [F.desc("n"), F.asc("o_custkey")], "place")


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.valid_points(table(spark, folder, "lineitem"), F.col("l_discount"), F.col("l_tax"))


# The steps of the fit: draws by hash with squared distances, then means in whole numbers until nothing moves.
HOTSPOTS = """
    WITH RECURSIVE places AS (
        SELECT CAST(round(l_discount * 1000000) AS BIGINT) AS x, CAST(round(l_tax * 1000000) AS BIGINT) AS y, count(*) AS w
        FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0 GROUP BY 1, 2),
    wanted AS (SELECT least(10, count(*)) AS k FROM places),
    draws AS (
        SELECT p.x, p.y, p.w, step, -ln((CAST('0x' || substr(md5('42:' || step || ':' || x || ':' || y), 1, 8) AS BIGINT)
               + CAST(0.5 AS DOUBLE)) / 4294967296) AS race FROM places p, range(10) steps(step)),
    seeds AS (
        SELECT 1 AS n, [min({'s': race / w, 'x': x, 'y': y})] AS cs FROM draws WHERE step = 0 HAVING count(*) > 0
        UNION ALL
        SELECT n + 1, list_append(any_value(cs), min({'s': race / CAST(w * gap AS DOUBLE), 'x': x, 'y': y})) FROM (
            SELECT n, cs, d.x, d.y, d.w, d.race, list_min(list_transform(cs, lambda c: (d.x - c.x) * (d.x - c.x) + (d.y - c.y) * (d.y - c.y))) AS gap
            FROM seeds JOIN draws d ON d.step = seeds.n, wanted WHERE n < k)
        WHERE gap > 0 GROUP BY n),
    fit AS (
        SELECT 0 AS n, list_transform(cs, lambda c: {'x': c.x, 'y': c.y}) AS cs, [CAST(0 AS BIGINT)] AS members, true AS moved
        FROM seeds WHERE n = (SELECT max(n) FROM seeds)
        UNION ALL
        SELECT n + 1, new, members, new <> cs FROM (
            SELECT n, any_value(cs) AS cs,
                   list_transform(range(1, len(any_value(cs)) + 1), lambda i: coalesce(
                       list_filter(list({'i': best, 'c': {'x': mx, 'y': my}}), lambda m: m.i = i)[1].c, any_value(cs)[i])) AS new,
                   list_transform(range(1, len(any_value(cs)) + 1), lambda i: coalesce(
                       list_filter(list({'i': best, 'w': w}), lambda m: m.i = i)[1].w, 0)) AS members
            FROM (SELECT n, any_value(cs) AS cs, best, CAST(sum(w) AS BIGINT) AS w,
                         CAST(floor((2 * sum(w * x) + sum(w)) / (2 * sum(w))) AS BIGINT) AS mx,
                         CAST(floor((2 * sum(w * y) + sum(w)) / (2 * sum(w))) AS BIGINT) AS my
                  FROM (SELECT n, cs, x, y, w, list_position(gaps, list_min(gaps)) AS best
                        FROM (SELECT n, cs, p.x, p.y, p.w, list_transform(cs, lambda c: (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y)) AS gaps
                              FROM fit, places p WHERE moved AND n < 100))
                  GROUP BY n, best)
            GROUP BY n)),
    fitted AS (SELECT cs, members FROM fit WHERE n = (SELECT max(n) FROM fit))
    SELECT CAST(i - 1 AS INTEGER) AS cluster_id, cs[i].x / 1000000 AS centroid_latitude, cs[i].y / 1000000 AS centroid_longitude,
           members[i] AS crime_count
    FROM (SELECT cs, members, unnest(range(1, len(cs) + 1)) AS i FROM fitted)
"""


@query("hotspots", HOTSPOTS)
def hotspots(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.hotspots(_points(spark, folder))


@query(
    "hotspots_empty",
    """
    SELECT CAST(NULL AS INTEGER) AS cluster_id, CAST(NULL AS DOUBLE) AS centroid_latitude, CAST(NULL AS DOUBLE) AS centroid_longitude,
           count(*) AS crime_count
    FROM lineitem WHERE l_discount > 90 HAVING count(*) > 0
    """,
)
def hotspots_empty(spark: SparkSession, folder: str) -> DataFrame:
    """No point is left: an empty result with the same columns."""
    return clusters.hotspots(_points(spark, folder).where(F.col("latitude") > 90))


@query(
    "hotspots_check",
    """
    SELECT least(10, (SELECT count(*) FROM (SELECT DISTINCT l_discount, l_tax FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0)))
               AS clusters,
           count(*) AS members, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_center
    FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0
    """,
)
def hotspots_check(spark: SparkSession, folder: str) -> DataFrame:
    """The fitted result itself: how many clusters and members, how many members lie
    nearer to another center, and how many centers are not the mean of their members."""
    points = _points(spark, folder)
    found = materialise(clusters.hotspots(points))
    centers = found.select("cluster_id", "centroid_latitude", "centroid_longitude")
    places = points.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("n"))
    placed = clusters.nearest_center(places, centers, k=10)
    weigh = lambda c: F.sum(F.col(c) * F.col("n")) / F.sum("n")
    nearest = placed.groupBy("cluster_id").agg(
        F.sum("n").alias("nearest"), weigh("latitude").alias("mid_latitude"), weigh("longitude").alias("mid_longitude")
    )
    far = (F.abs(F.col("mid_latitude") - F.col("centroid_latitude")) > 1e-4) | (
        F.abs(F.col("mid_longitude") - F.col("centroid_longitude")) > 1e-4
    )
    compared = found.join(nearest, "cluster_id", "left")
    return compared.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.sum("crime_count").alias("members"),
        (F.sum(F.abs(F.col("crime_count") - F.coalesce("nearest", F.lit(0)))) / 2).cast("long").alias("misplaced"),
        F.count_if(far).alias("off_center"),
    )


CELLS = """
    SELECT CAST(round(l_discount * 100) AS INTEGER) // 3 * 10 + CAST(round(l_tax * 100) AS INTEGER) // 3 AS cluster_id,
           round(avg(l_discount), 6) AS cx, round(avg(l_tax), 6) AS cy
    FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0 GROUP BY 1
"""


def cell_centers(points: DataFrame) -> DataFrame:
    """Means of coarse cells as centers, with their members: the same on every run."""
    cell = F.floor(F.round(F.col("latitude") * 100) / 3) * 10 + F.floor(F.round(F.col("longitude") * 100) / 3)
    return points.groupBy(cell.cast("int").alias("cluster_id")).agg(
        F.round(F.avg("latitude"), 6).alias("cx"), F.round(F.avg("longitude"), 6).alias("cy"), F.count(F.lit(1)).alias("members")
    )


@query(
    "nearest_center",
    f"""
    SELECT latitude, longitude, cluster_id, count(*) AS crime_count FROM (
        SELECT p.l_discount AS latitude, p.l_tax AS longitude,
               (SELECT min((pow(p.l_discount - c.cx, 2) + pow(p.l_tax - c.cy, 2), c.cluster_id)) FROM ({CELLS}) c)[2] AS cluster_id
        FROM lineitem p WHERE l_discount <> 0 AND l_tax <> 0)
    GROUP BY 1, 2, 3
    """,
)
def nearest_center(spark: SparkSession, folder: str) -> DataFrame:
    """Centers are the means of coarse cells, so they come from the table too."""
    points = _points(spark, folder)
    centers = cell_centers(points).drop("members")
    placed = clusters.nearest_center(points, centers, k=16)
    return placed.groupBy("latitude", "longitude", "cluster_id").agg(F.count(F.lit(1)).alias("crime_count"))


@query(
    "hop_counts",
    f"""
    SELECT event_type, strftime(make_timestamp(start_s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp((start_s + {SIZE}) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, event_count
    FROM ({HOPS})
    """,
)
def hop_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = hops.hop_counts(table(spark, folder, "events"), "event_type", "ts", SIZE, SLIDE)
    return counts.withColumns({c: stamp(c) for c in ("window_start", "window_end")})


@query(
    "tumbling_counts",
    f"""
    SELECT event_type, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp((s + {SLIDE}) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS event_count
    FROM (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // {SLIDE} * {SLIDE} AS s FROM events) GROUP BY event_type, s
    """,
)
def tumbling_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = hops.tumbling_counts(table(spark, folder, "events"), "event_type", "ts", SLIDE)
    return counts.withColumns({c: stamp(c) for c in ("window_start", "window_end")})


@query(
    "trailing_count",
    f"""
    SELECT k AS key, t, n, first_id,
           CAST(COALESCE(sum(n) OVER (PARTITION BY k ORDER BY t RANGE BETWEEN {SIZE} PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT)
               AS event_count
    FROM (SELECT event_type AS k, CAST(floor(epoch(ts)) AS BIGINT) AS t, count(*) AS n, min(event_id) AS first_id
          FROM events GROUP BY 1, 2)
    """,
)
def trailing_count(spark: SparkSession, folder: str) -> DataFrame:
    seconds = trailing.per_second(table(spark, folder, "events"), "event_type", "ts", "event_id")
    return trailing.trailing_counts(seconds, SIZE).drop("chunk")

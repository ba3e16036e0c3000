"""Every registered query against its SQL on DuckDB, over the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from tallyline.bindings import load

FOLDER = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 6) + 0.0
        return value

    made = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(made, key=lambda row: [(v is None, str(v)) for v in row])


def test_registers_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    queries, oracle = load().QUERIES, load().ORACLE
    assert set(queries) <= set(contract.queries()) and set(oracle) <= set(queries)
    assert set(queries) == set(oracle)


def test_entry(spark):
    assert contract.entry(spark).columns == ["trend_type", "trend_key", "crime_count"]


@pytest.mark.parametrize("name", sorted(load().ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {n: TYPES[t] for n, t in frame.dtypes} == kinds
    assert comparable(frame.columns, frame.collect()) == comparable(columns, result.fetchall())


def test_hotspot_query(spark):
    rows = contract.queries()["hotspots"](spark, FOLDER).collect()
    points = contract.queries()["valid_points"](spark, FOLDER).count()
    assert 0 < len(rows) <= 10 and sum(r["crime_count"] for r in rows) == points


def test_trends_do_not_join(spark):
    plan = contract.queries()["trend_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_ranked_rows_are_shuffled_once(spark):
    """The range sort lies before the checkpoint; what reads the places exchanges nothing wide."""
    plan = contract.queries()["rank_in_order"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]

"""The registered queries: all thirteen and the pipeline, and those with SQL against DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from tallyline.llm.queries import ORACLE, QUERIES
from tests.test_oracle import TABLES, TYPES, comparable

FOLDER = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) == {"op8_warc", "op10_curriculum_mix", "op11_importance_resampling", "op13_lexical_search"} <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as duck:
        for table in TABLES:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        result = duck.execute(ORACLE[name])
        columns, kinds = [d[0] for d in result.description], {d[0]: str(d[1]) for d in result.description}
        frame = QUERIES[name](spark, FOLDER)
        assert {n: TYPES[t] for n, t in frame.dtypes} == kinds
        assert comparable(frame.columns, frame.collect()) == comparable(columns, result.fetchall())


@pytest.mark.parametrize(
    "name, columns",
    [
        ("op3_language_id", ["doc_id", "held_out", "lang_pred", "score"]),
        ("op4_embedding_near_dedup", ["vec_id", "n_links", "component_id", "kept"]),
        ("op7_toxicity", ["doc_id", "held_out", "score", "predicted"]),
        ("op12_bpe_forced_boundaries", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
        ("op9_simhash_near_dedup", ["doc_id", "fingerprint", "component_id"]),
    ],
)
def test_contract_columns(spark, name, columns):
    frame = QUERIES[name](spark, FOLDER)
    table = "embeddings" if name.startswith("op4") else "documents"
    assert frame.columns[: len(columns)] == columns
    assert frame.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_held_out_languages(spark):
    frame = QUERIES["op3_language_id"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id")
    rows = frame.where("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)

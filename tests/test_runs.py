"""The batch run from raw files to served tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.plans import contracts, runs
from tallyline.plans.density import sex_offender_density
from tallyline.serving import reads
from tallyline.sources import records
from tallyline.sources.schemas import RAW_SCHEMAS


def raw_rows(spark, dataset, rows):
    schema = RAW_SCHEMAS[dataset]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Five small CSV files, read back as the job would."""
    rnd = random.Random(5)
    frames = {
        "crimes": [
            {
                "ID": str(i), "Case Number": f"HX{i % 190}", "Date": f"{1 + i % 12:02d}/15/{2020 + i % 3} 0{1 + i % 9}:00:00 PM",
                "Block": f" 0{i % 9}XX  main st", "Primary Type": rnd.choice(["THEFT", "BATTERY", "FRAUD"]),
                "District": str(1 + i % 4) + (".0" if i % 2 else ""), "Latitude": str(41 + i % 5 / 10),
                "Longitude": str(-87 - i % 3 / 10), "Arrest": "true",
            }
            for i in range(200)
        ],
        "arrests": [{"CB_NO": str(i), "CASE NUMBER": f"hx{i * 3}", "RACE": rnd.choice(["A", "B", None])} for i in range(60)],
        "violence": [
            {
                "CASE_NUMBER": f"V{i}", "DATE": "2021-05-01 10:00:00" if i % 5 else None, "MONTH": str(i % 12), "DISTRICT": str(1 + i % 4),
                "COMMUNITY_AREA": f"AREA {i % 25}", "INCIDENT_PRIMARY": rnd.choice(["HOMICIDE", "BATTERY"]),
                "VICTIMIZATION_PRIMARY": rnd.choice(["HOMICIDE", "BATTERY", None]), "GUNSHOT_INJURY_I": rnd.choice(["Y", "N"]),
            }
            for i in range(120)
        ],
        "sex_offenders": [
            {"LAST": f"L{i}", "BLOCK": ["01xx MAIN st", "02XX  main ST", "", "9999 NOWHERE"][i % 4], "VICTIM MINOR": "Y" if i % 3 else "N"}
            for i in range(40)
        ],
        "police_stations": [
            {"DISTRICT": "2", "DISTRICT NAME": "Second"}, {"DISTRICT": "2", "DISTRICT NAME": "Another"},
            {"DISTRICT": "Headquarters", "DISTRICT NAME": "HQ"},
        ],
    }
    out = {}
    for name, rows in frames.items():
        path = str(tmp_path_factory.mktemp("raw") / name)
        records.write_csv(raw_rows(spark, name, rows), path)
        out[name] = records.read_dataset(spark, name, path)
    return out


@pytest.fixture(scope="module")
def store(spark, raw, tmp_path_factory):
    made = runs.RunStore(spark, str(tmp_path_factory.mktemp("store")))
    runs.run_batch(made, raw, "batch_20240101_000000", k=3)
    return made


def rows_of(store, table):
    return store.read(table).where(F.col("run_id") == "batch_20240101_000000")


def test_run_publishes_every_table(spark, store):
    state = runs.ledger_state(store.ledger()).first()
    assert state["status"] == "completed" and state["finished_at"] >= state["started_at"]
    assert state["last_successful_run"] == state["finished_at"]
    counts = {r[0]: r[1] for r in runs.row_counts(store, "batch_20240101_000000").collect()}
    assert set(counts) == set(contracts.RESULT_TABLES) and all(n > 0 for n in counts.values())
    assert all(f"{table}={n}" in state["message"] for table, n in counts.items())
    for table in contracts.RESULT_TABLES:
        expected = [("run_id", "string")] + [(n, {"long": "bigint"}.get(t, t)) for n, t in contracts.columns_of(table)]
        expected.append((contracts.CREATED, "timestamp"))
        assert store.read(table).dtypes == expected


def test_invariants(store, raw):
    trends = {r["trend_type"]: r["total_count"] for r in reads.trend_check(rows_of(store, "crime_trends")).collect()}
    assert trends == dict.fromkeys(["year", "month", "day_of_week", "hour"], 200)
    assert rows_of(store, "arrest_rates").where("total_arrests > total_crimes").count() == 0
    density = rows_of(store, "sex_offender_density")
    assert density.agg(F.sum("offender_count")).first()[0] == 40
    lost = reads.unmatched_row(density).first()
    assert lost["offender_count"] == 20 and lost["density_rank"] is None
    names = {r["district"]: r["district_name"] for r in reads.ranked_areas(density).collect()}
    assert set(names.values()) <= {"Another", "District name unavailable"}
    assert rows_of(store, "hotspots").agg(F.sum("crime_count")).first()[0] == 200
    stats = rows_of(store, "violence_stats")
    assert stats.where("month <> 'ALL'").agg(F.sum("total_incidents")).first()[0] == 120
    assert reads.top_groups(stats).count() == 20
    assert {r[0] for r in rows_of(store, "correlations").select("correlation_name").distinct().collect()} == {
        "violence_rate_vs_arrest_rate_by_district", "sex_offender_density_vs_crime_rate_by_district",
    }


def test_publish_twice_changes_nothing(store):
    run = "batch_20240101_000000"
    before = sorted(map(tuple, store.read("crime_trends").collect()))
    with pytest.raises(ValueError, match="nothing is staged"):
        store.publish(run, ["crime_trends"])
    store.stage(store.spark.createDataFrame(before, store.read("crime_trends").schema), "crime_trends", run)
    for _ in range(2):
        assert store.publish(run, ["crime_trends"]) == {"crime_trends": len(before)}
        assert sorted(map(tuple, store.read("crime_trends").collect())) == before


def test_empty_result_replaces_earlier_rows(spark, store):
    rows = store.read("hotspots").drop("run_id")
    assert store.stage(rows, "hotspots", "batch_9") > 0
    assert store.stage(rows.where("cluster_id < 0"), "hotspots", "batch_9") == 0
    assert store.publish("batch_9", ["hotspots"]) == {"hotspots": 0}
    assert store.read("hotspots").where("run_id = 'batch_9'").count() == 0


def test_failed_run_is_marked_and_not_published(spark, raw, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    broken = dict(raw, violence=raw["violence"].withColumn("DISTRICT", F.raise_error(F.lit("boom" * 900)).cast("string")))
    with pytest.raises(Exception):
        runs.run_batch(store, broken, "batch_1", k=2)
    state = runs.ledger_state(store.ledger()).first()
    assert state["status"] == "failed" and "boom" * 900 in state["message"] and state["last_successful_run"] is None
    assert all(store.read(t).isEmpty() for t in contracts.RESULT_TABLES)
    assert reads.latest_run(runs.ledger_state(store.ledger())).isEmpty()
    assert reads.of_latest_run(store.read("crime_trends"), runs.ledger_state(store.ledger())).isEmpty()


def test_latest_completed_run_wins_over_newer_failure(spark, store):
    store.mark("batch_20240102_000000", "job", "running")
    store.mark("batch_20240102_000000", "job", "failed", "no space")
    states = runs.ledger_state(store.ledger())
    assert [r["run_id"] for r in reads.latest_run(states).collect()] == ["batch_20240101_000000"]
    assert [r["run_id"] for r in reads.recent_runs(states).collect()][0] == "batch_20240102_000000"
    shown = reads.of_latest_run(store.read("crime_trends"), states)
    assert shown.count() == rows_of(store, "crime_trends").count()


def test_latest_run_reads_one_partition(store):
    shown = reads.of_latest_run(store.read("crime_trends"), runs.ledger_state(store.ledger()))
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_protocol_refuses(store):
    with pytest.raises(ValueError, match="unknown result table"):
        store.publish("batch_20240101_000000", ["weather"])
    with pytest.raises(ValueError, match="unknown status"):
        store.mark("r", "j", "paused")
    with pytest.raises(ValueError, match="run id"):
        store.stage(store.read("hotspots"), "hotspots", "../x")


def test_no_unmatched_row_when_all_match(spark):
    incidents = spark.createDataFrame([("A", "7"), ("A", "8"), ("A", "8")], "block string, district string")
    registry = spark.createDataFrame([(" a", "Y"), ("A ", None)], "block string, victim_minor string")
    names = spark.createDataFrame([("8", "Eighth")], "district string, district_name string")
    got = sex_offender_density(registry, names, incidents).collect()
    assert [tuple(r) for r in got] == [("008", "Eighth", 2, 1, 1)]


def test_correlations_against_brute_force(spark, store, raw):
    """Violence and arrest rate per area, from the raw rows."""
    crimes = {}
    for r in raw["crimes"].collect():
        crimes.setdefault(r["Case Number"].strip(), []).append((r["Primary Type"], f"00{r['District'][0]}"))
    area = {case: min(rows)[1] for case, rows in crimes.items()}
    hit = {r["CASE NUMBER"].upper() for r in raw["arrests"].collect()}
    victims = [f"00{r['DISTRICT']}" for r in raw["violence"].collect()]
    expected = {}
    for one in set(area.values()):
        cases = [c for c in area if area[c] == one]
        expected[one] = (victims.count(one) / len(cases), sum(c in hit for c in cases) / len(cases))
    rows = rows_of(store, "correlations").where("x_metric = 'violence_rate'").collect()
    got = {r["grouping_key"]: (r["x_value"], r["y_value"]) for r in rows}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)
    assert len({r["correlation_value"] for r in rows}) == 1 and -1 <= rows[0]["correlation_value"] <= 1


def leftovers(folder):
    return [p.name for kind in ("clean", "staging") for p in (folder / kind).rglob("run_id=*")]


def test_nothing_is_left_of_intermediate_tables(spark, raw, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    runs.run_batch(store, raw, "batch_1", k=2)
    assert leftovers(tmp_path) == []
    broken = dict(raw, violence=raw["violence"].withColumn("DISTRICT", F.raise_error(F.lit("boom")).cast("string")))
    with pytest.raises(Exception, match="boom"):
        runs.run_batch(store, broken, "batch_2", k=2)
    assert leftovers(tmp_path) == []
    with pytest.raises(ValueError, match="used already"):
        runs.run_batch(store, raw, "batch_1", k=2)


def test_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tallyline import session

    def fake(master, named=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
        assert session.shared_dir(fake(master, "/shared")) == "/shared"


def test_batch_job_reads_parquet_and_cleans_up(spark, raw, tmp_path):
    from tallyline import __main__ as jobs

    given = ["--master", "local[2]", "batch", "--store", str(tmp_path / "store"), "--run-id", "r1", "--input-format", "parquet", "--clusters", "2"]
    for name, frame in raw.items():
        records.to_parquet(frame, str(tmp_path / name))
        given += [f"--{name}", str(tmp_path / name)]
    args = jobs.parser().parse_args(given)
    args.job(args)
    state = runs.ledger_state(runs.RunStore(spark, str(tmp_path / "store")).ledger()).first()
    assert state["status"] == "completed" and not list((tmp_path / "store").glob("work/*"))


def trend(spark, *keys):
    return spark.createDataFrame([("month", k, n) for k, n in keys], "trend_type string, trend_key string, crime_count long")


def spots(spark, *rows):
    return spark.createDataFrame(rows, "cluster_id int, centroid_latitude double, centroid_longitude double, crime_count long")


def held(store, run):
    rows = [store.read(t).where(F.col("run_id") == run).drop("run_id", contracts.CREATED).collect() for t in ("crime_trends", "hotspots")]
    return [sorted(map(tuple, r)) for r in rows]


@pytest.mark.parametrize("at", ["second table", "commit"])
def test_broken_publish_leaves_the_older_one_whole(spark, tmp_path, monkeypatch, at):
    store = runs.RunStore(spark, str(tmp_path))
    store.stage(trend(spark, ("a", 1)), "crime_trends", "r")
    store.stage(spots(spark, (0, 1.0, 2.0, 3)), "hotspots", "r")
    store.publish("r", ["crime_trends", "hotspots"])
    before = held(store, "r")
    store.stage(trend(spark, ("b", 7), ("c", 8)), "crime_trends", "r")
    store.stage(spots(spark, (0, 9.0, 9.0, 9)), "hotspots", "r")
    real = runs.RunStore._write

    def broken(self, df, run_id, path):
        if "final/hotspots" in path:
            raise RuntimeError("lost")
        return real(self, df, run_id, path)

    with monkeypatch.context() as patch:
        if at == "commit":
            patch.setattr(runs, "write_whole", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            patch.setattr(runs.RunStore, "_write", broken)
        with pytest.raises(RuntimeError, match="lost"):
            store.publish("r", ["crime_trends", "hotspots"])
    assert held(store, "r") == before == [[("month", "a", 1)], [(0, 1.0, 2.0, 3)]]
    assert len(list(tmp_path.glob("final/*/run_id=r/part=*"))) == 2  # nothing is left of the broken one
    reader = store.read("crime_trends")
    store.publish("r", ["crime_trends", "hotspots"])
    assert held(store, "r") == [[("month", "b", 7), ("month", "c", 8)], [(0, 9.0, 9.0, 9)]]
    assert reader.count() == 1  # who began to read before sees what was there then
    store.drop_replaced()
    assert len(list(tmp_path.glob("final/*/run_id=r/part=*"))) == 2
    assert held(store, "r") == [[("month", "b", 7), ("month", "c", 8)], [(0, 9.0, 9.0, 9)]]


def test_commits_name_what_was_published(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    assert store.commits().count() == 0 and store.published("hotspots") == {}
    for run in ("r1", "r2", "r1"):
        store.stage(trend(spark, (run, 1)), "crime_trends", run)
        store.publish(run, ["crime_trends"])
    rows = store.commits().collect()
    assert sorted((r["number"], r["run_id"], r["table"], r["rows"]) for r in rows) == [(1, "r1", "crime_trends", 1), (2, "r2", "crime_trends", 1), (3, "r1", "crime_trends", 1)]
    assert set(store.published("crime_trends")) == {"r1", "r2"}
    assert store.published("crime_trends")["r1"] == next(r["part"] for r in rows if r["number"] == 3)


TABLES = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", ["incidents", "victims", "block_incidents"])
def test_areas_are_made_before_the_joins(spark, name):
    """Once per customer or supplier: in the plan the texts are worked on below the last join."""
    from tallyline.bindings import tables

    plan = getattr(tables, name)(spark, TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") > plan.rindex("Join Inner")


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_rates_and_correlations_of_a_run_share_one_tally(spark, monkeypatch):
    from tallyline.bindings import runs as fixture

    made, tally = [], fixture.outcome_plan.case_tally
    monkeypatch.setattr(fixture.outcome_plan, "case_tally", lambda *tables: made.append(1) or tally(*tables))
    folder = f"{TABLES}/."  # a name of its own, so nothing is kept of it yet
    rows = [fixture._result(spark, folder, name, fixture.NEW).count() for name in ("arrest_rates", "correlations")]
    assert all(rows) and made == [1]

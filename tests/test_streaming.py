"""Streams against their batch twins: many micro-batches, restarts, replays."""

import json
import random
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline.operators import hops, trailing
from tallyline.sources import events
from tallyline.streaming import alerts, sinks, summary, windows

SIZE, SLIDE = 300, 60
MINIMA = {"LOW": 4, "MEDIUM": 6, "HIGH": 8}


def made_events(n=400):
    rnd = random.Random(11)
    now, out = 1704067200, []
    for i in range(n):
        now += rnd.choice([0, 0, 1, 5, 30, 200])
        out.append((i, now, rnd.choice(["7", "7", "7.0", "012"])))
    return out


def line(i, t, district):
    date = datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    return json.dumps(
        {"case_number": str(i), "date": date, "block": "B", "primary_type": "T", "district": district, "arrest": "no",
         "latitude": 1, "longitude": 2}
    )


def write_topic(folder: Path, rows, first=0, size=80):
    """Files in time order; their times of change differ, so the source keeps the order."""
    import os

    folder.mkdir(exist_ok=True)
    for number, start in enumerate(range(0, len(rows), size), first):
        path = folder / f"part-{number:04d}.txt"
        path.write_text("\n".join(line(*r) for r in rows[start:start + size]) + "\n")
        os.utime(path, (1704067200 + number * 10,) * 2)


def stream(spark, folder, files=1):
    lines = events.read_event_stream(spark, "text", str(folder), maxFilesPerTrigger=str(files))
    return timed(events.accepted(events.parse_events(lines)))


def timed(good):
    return good.withColumns(
        {"moment": events.event_time(F.col("date")), "ident": F.col("case_number").cast("long")}
    )


def batch(spark, folder):
    return timed(events.accepted(events.parse_events(spark.read.text(str(folder)))))


def batch_emits(spark, folder):
    seconds = trailing.per_second(batch(spark, folder), "district", "moment", "ident")
    return trailing.trailing_emits(seconds, SIZE, SLIDE)


def run_alerts(spark, folder, store, checkpoint, files=1):
    emits = windows.trailing_stream(stream(spark, folder, files), "district", "moment", "ident", SIZE, SLIDE)
    query = sinks.start_alerts(emits, store, str(checkpoint), minima=MINIMA, threshold=4)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def topic(tmp_path_factory):
    folder = tmp_path_factory.mktemp("topic")
    write_topic(folder, made_events())
    return folder


def like(spark, rows):
    return spark.createDataFrame([], rows.schema)


def shape_counts(spark):
    return spark.createDataFrame([], "district string, window_start timestamp, window_end timestamp, event_count long, updated_at timestamp")


def shape_alerts(spark):
    return spark.createDataFrame(
        [], "alert_id string, district string, alert_timestamp timestamp, window_start timestamp, window_end timestamp, "
        "event_count long, threshold_value long, severity string, message string, source string",
    )


def live_counts(spark, store):
    rows = store.counts.latest(shape_counts(spark)).select("district", F.unix_seconds("window_end"), "event_count")
    return sorted(map(tuple, rows.collect()))


def expected_counts(spark, folder):
    rows = batch_emits(spark, folder).select("key", "window_end", "event_count")
    return sorted(map(tuple, rows.collect()))


def test_alert_stream_in_many_batches_equals_batch(spark, topic, tmp_path):
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    run_alerts(spark, topic, store, tmp_path / "cp")
    assert live_counts(spark, store) == expected_counts(spark, topic)

    expected = alerts.alert_rows(alerts.anomaly_rows(batch_emits(spark, topic), "key", MINIMA, 4))
    columns = ["alert_id", "district", "event_count", "threshold_value", "severity", "message", "source"]
    got = store.alerts.stored(shape_alerts(spark))
    assert got.select("batch_id").distinct().count() > 2
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))

    documents = store.documents.latest(alerts.alert_documents(shape_alerts(spark)))
    assert documents.count() == expected.count()
    assert {"timestamp", "threshold"} <= set(documents.columns)


def test_restart_from_checkpoint_goes_on(spark, tmp_path):
    rows = made_events(240)
    folder, store = tmp_path / "topic", sinks.AlertStore(spark, str(tmp_path / "out"))
    write_topic(folder, rows[:120], 0, 60)
    run_alerts(spark, folder, store, tmp_path / "cp")
    write_topic(folder, rows[120:], 2, 60)
    run_alerts(spark, folder, store, tmp_path / "cp")
    assert live_counts(spark, store) == expected_counts(spark, folder)
    assert store.counts.stored(shape_counts(spark)).select("writer").distinct().count() == 1


def test_full_replay_from_a_fresh_checkpoint_adds_nothing(spark, topic, tmp_path):
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    run_alerts(spark, topic, store, tmp_path / "cp1", files=2)
    before = store.alerts.stored(shape_alerts(spark)).count()
    run_alerts(spark, topic, store, tmp_path / "cp2", files=5)
    assert before > 0 and store.alerts.stored(shape_alerts(spark)).count() == before
    assert live_counts(spark, store) == expected_counts(spark, topic)


def test_late_event_is_counted_but_emits_nothing(spark, tmp_path):
    base = 1704067200
    folder, store = tmp_path / "topic", sinks.AlertStore(spark, str(tmp_path / "out"))
    write_topic(folder, [(0, base, "7"), (1, base + 100, "7"), (2, base + 50, "7"), (3, base + 200, "7")], 0, 2)
    run_alerts(spark, folder, store, tmp_path / "cp")
    assert [(end - base, n) for _, end, n in live_counts(spark, store)] == [(0, 1), (100, 2), (200, 4)]


def test_hop_stream_equals_batch(spark, topic, tmp_path):
    counts = windows.hop_stream(stream(spark, topic), "district", "moment", SIZE, SLIDE, "1 hour")
    target = sinks.BatchTable(spark, str(tmp_path / "hops"), ("district", "window_start", "window_end"), "window_start")
    sinks.start_batches(counts, target.upsert, str(tmp_path / "cp"), "update").awaitTermination()
    shape = spark.createDataFrame([], "district string, window_start timestamp, window_end timestamp, event_count long")
    got, expected = target.latest(shape), hops.hop_counts(batch(spark, topic), "district", "moment", SIZE, SLIDE)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_hop_stream_in_append_mode_emits_only_final_windows(spark, topic, tmp_path):
    counts = windows.hop_stream(stream(spark, topic), "district", "moment", SIZE, SLIDE, "0 seconds")
    target = sinks.BatchTable(spark, str(tmp_path / "hops"), ("district", "window_start", "window_end"), "window_start")
    sinks.start_batches(counts, target.upsert, str(tmp_path / "cp"), "append").awaitTermination()
    shape = spark.createDataFrame([], "district string, window_start timestamp, window_end timestamp, event_count long")
    got, expected = target.latest(shape), hops.hop_counts(batch(spark, topic), "district", "moment", SIZE, SLIDE)
    assert got.count() > 0 and got.exceptAll(expected).count() == 0


def test_quarantine_and_raw_log_streams(spark, tmp_path):
    folder = tmp_path / "topic"
    write_topic(folder, made_events(20), 0, 10)
    (folder / "bad.txt").write_text('oops\n{"case_number": "1"}\n')
    lines = events.read_event_stream(spark, "text", str(folder))
    parsed = events.parse_events(lines)
    sinks.start_quarantine(events.quarantined(parsed), str(tmp_path / "bad"), str(tmp_path / "cp1")).awaitTermination()
    refused = spark.read.json(str(tmp_path / "bad"))
    assert sorted(r["reject_reason"] for r in refused.collect()) == ["missing_date", "not_json"]

    log = events.raw_documents(events.accepted(parsed), events.event_time(F.col("date")))
    sinks.start_raw_log(log, str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "log"))
    assert kept.count() == 20 and kept.where("event_id = case_number || '_' || date").count() == 20
    assert events.retained(kept, F.lit("2030-01-01").cast("timestamp")).count() == 0


def test_upsert_last_write_wins(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    day = F.lit("2024-01-01").cast("timestamp").alias("at")

    def rows(*pairs):
        return spark.createDataFrame(pairs, "k string, n int").select("k", "n", day)

    shape = like(spark, rows(("a", 1)))
    assert table.latest(shape).count() == 0
    table.upsert(rows(("a", 1), ("b", 1)), 0, "q")
    table.upsert(rows(("a", 2)), 1, "q")
    table.upsert(rows(("a", 2)), 1, "q")
    assert sorted((r["k"], r["n"]) for r in table.latest(shape).collect()) == [("a", 2), ("b", 1)]
    table.upsert(rows(("b", 9)), 0, writer="another query")
    assert sorted((r["k"], r["n"]) for r in table.latest(shape).collect()) == [("a", 2), ("b", 9)]


def test_insert_absent_repeats_cleanly(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    day = F.lit("2024-01-01").cast("timestamp").alias("at")

    def rows(*pairs):
        return spark.createDataFrame(pairs, "k string, n int").select("k", "n", day)

    first = rows(("a", 1), ("a", 1), ("b", 1))
    for _ in range(2):
        assert table.insert_absent(first, 0, "q").count() == 2
    for _ in range(2):
        assert [r["k"] for r in table.insert_absent(rows(("a", 7), ("c", 7)), 1, "q").collect()] == ["c"]
    assert table.insert_absent(first.where("k = 'z'"), 2, "q").count() == 0
    assert sorted((r["k"], r["n"]) for r in table.stored(first).collect()) == [("a", 1), ("b", 1), ("c", 7)]


def test_summary(spark):
    parsed = events.parse_events(spark.createDataFrame([(line(1, 0, "7"),), ("x",)], "value string"))
    rows = spark.createDataFrame([("007", 0, 1, 9, 4, "HIGH"), ("007", 0, 2, 1, 4, None)],
                                 "district string, window_start long, window_end long, event_count long, threshold_value long, severity string")
    assert tuple(alerts.stream_summary(parsed, rows).first()) == (2, 1, 2, 1)


def dated_rows(spark, *rows):
    frame = spark.createDataFrame(rows, "k string, n int, day_number int")
    return frame.select("k", "n", F.timestamp_seconds(F.col("day_number") * 86400).alias("at"))


def test_batches_touch_their_own_days(spark, tmp_path, monkeypatch):
    """The folders looked at do not grow with older days, and pages stop at the newest that fill them."""
    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    for day in range(6):
        table.upsert(dated_rows(spark, (f"a{day}", 1, day), (f"b{day}", 1, day)), day, "q")
    seen = []
    real = sinks.path_exists
    monkeypatch.setattr(sinks, "path_exists", lambda session, path: seen.append(path) or real(session, path))
    added = table.insert_absent(dated_rows(spark, ("a5", 9, 5), ("c5", 9, 5)), 9, "q")
    assert [r["k"] for r in added.collect()] == ["c5"]
    assert {path.rsplit("/", 1)[1] for path in seen} == {"day=1970-01-06"}
    shape = like(spark, dated_rows(spark, ("x", 1, 0)))
    page = table.newest(shape, 4)
    assert sorted(r["k"] for r in page.collect()) == ["a4", "a5", "b4", "b5", "c5"]
    files = set(page.inputFiles())
    assert files and all("day=1970-01-05" in f or "day=1970-01-06" in f for f in files)


def test_days_of_a_batch_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Many small days go to all cores, a file each; only a large one has several files."""
    def written():
        found = [p for p in (tmp_path / "t").rglob("part-*.parquet")]
        return Counter(p.parent.parent.name for p in found), {p.name.split("-")[1] for p in found}

    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    rows = dated_rows(spark, *((f"a{n}", n, n % 60) for n in range(240)), ("z", 0, None))
    table.upsert(rows, 0, "q")
    files, tasks = written()
    assert len(files) == 61 and set(files.values()) == {1}
    assert min(2, spark.sparkContext.defaultParallelism) <= len(tasks) <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sinks, "TASK_ROWS", 50)
    large = dated_rows(spark, *((f"b{n}", n, 3 if n < 400 else None if n < 600 else n) for n in range(620)))
    table.upsert(large, 0, "q")
    files, _ = written()
    assert files["day=1970-01-04"] > 1 and files["day=__HIVE_DEFAULT_PARTITION__"] > 1
    assert all(n == 1 for day, n in files.items() if day not in ("day=1970-01-04", "day=__HIVE_DEFAULT_PARTITION__"))
    assert table.stored(large).where("k like 'b%'").select("k", "n", "at").exceptAll(large).isEmpty()
    assert table.stored(large).where("k like 'b%'").count() == 620


@pytest.mark.parametrize(("span", "first_days"), [("month", ["2024-01-01", "2024-02-01", "2024-03-01"]), ("year", ["2024-01-01"])])
def test_folders_of_a_longer_span_hold_the_same_rows(spark, tmp_path, span, first_days):
    """A batch makes a folder per month or year, not per day; writing, reading and expiry agree with days."""
    begin = 19723  # 2024-01-01
    rows = dated_rows(spark, *((f"a{n}", n, begin + n % 70) for n in range(140)), ("z", 0, None))
    shape, kept = like(spark, rows), []
    for kind in ("day", span):
        table = sinks.BatchTable(spark, str(tmp_path / kind), ("k",), "at", span=kind)
        table.upsert(rows, 0, "q")
        table.upsert(rows, 0, "q")
        table.upsert(rows.where("n < 3").withColumn("n", F.col("n") + 1000), 1, "q")
        added = table.insert_absent(dated_rows(spark, ("a5", 9, begin + 5), ("new", 9, begin + 69)), 2, "q")
        assert [r["k"] for r in added.collect()] == ["new"]
        page = {r["k"] for r in table.newest(shape, 5).collect()}
        assert {"a69", "a139", "new"} <= page
        if kind == span:
            assert [d.isoformat() for d in table.days()] == first_days[::-1]
            assert len(list((tmp_path / kind).glob("day=*/batch=q-0"))) == len(first_days) + 1
            table.fold(shape, table.days()[-1])
        all_rows = sorted(map(tuple, table.latest(shape).collect()))
        for _ in range(2):
            table.expire(datetime(2024, 2, 14, 0, 0))
        kept.append((all_rows, sorted(map(tuple, table.latest(shape).collect()))))
    assert kept[0] == kept[1]
    assert len(kept[0][0]) == 142 and {k for k, *_ in kept[0][1]} == {"z", "new"} | {f"a{n}" for n in range(140) if n % 70 >= 44}
    with pytest.raises(ValueError, match="span"):
        sinks.BatchTable(spark, str(tmp_path / "odd"), ("k",), "at", span="week")


def test_stream_hop_counts_makes_no_folder_per_day(spark, tmp_path, monkeypatch):
    """Events of two years: the folders are as many as the months, the rows those of the batch twin."""
    from tallyline.bindings import streams as fixture

    made = spark.range(400).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1704067200 + F.col("id") * 155_000).alias("ts"), F.col("id").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    made.write.parquet(str(tmp_path / "events.parquet"))
    tables, real = [], sinks.start_batches

    def watched(rows, save, *rest, **more):
        tables.append(save.__self__)
        return real(rows, save, *rest, **more)

    monkeypatch.setattr(sinks, "start_batches", watched)
    got = fixture.stream_hop_counts(spark, str(tmp_path))
    twin = hops.hop_counts(made, "event_type", "ts", fixture.SIZE, fixture.SLIDE)
    twin = twin.withColumns({c: fixture.stamp(c) for c in ("window_start", "window_end")}).select(*got.columns)
    assert got.exceptAll(twin).isEmpty() and got.count() == twin.count() == 400 * 6
    (table,) = tables
    assert 20 <= len(table.days()) <= 25
    assert len(list(Path(table.path.removeprefix("file:")).glob("day=*/batch=*"))) <= 25 + fixture.FEEDS


def test_fold_keeps_the_winners(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    for batch, n in enumerate((1, 2, 3)):
        table.upsert(dated_rows(spark, ("a", n, 0), (f"b{n}", n, 0)), batch, "q")
    shape = like(spark, dated_rows(spark, ("x", 1, 0)))
    before = sorted(map(tuple, table.latest(shape).collect()))
    table.fold(shape, table.days()[0])
    assert sorted(map(tuple, table.latest(shape).collect())) == before and len(before) == 4
    assert len(list((tmp_path / "t" / "day=1970-01-01").glob("batch=*"))) == 1
    table.upsert(dated_rows(spark, ("a", 9, 0)), 3, "q")
    assert {r["k"]: r["n"] for r in table.latest(shape).collect()}["a"] == 9


def test_older_clock_does_not_win_within_a_query(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), ("k",), "at")
    shape = like(spark, dated_rows(spark, ("x", 1, 0)))
    table.upsert(dated_rows(spark, ("a", 2, 0)), 1, "q")
    table.upsert(dated_rows(spark, ("a", 1, 0)), 0, "q")
    assert [r["n"] for r in table.latest(shape).collect()] == [2]


def backlog(folder, count=500, arrival=False):
    """One event of one area per second, written at once."""
    folder.mkdir()
    rows = [line(i, 1704067200 + i, "7") for i in range(count)] + ["not json", '{"case_number": "1"}']
    if arrival:
        stamps = [datetime.fromtimestamp(1704067200 + i, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z") for i in range(len(rows))]
        rows = [json.dumps({"value": v, "timestamp": t}) for v, t in zip(rows, stamps, strict=True)]
    (folder / "part-0.txt").write_text("\n".join(rows) + "\n")


@pytest.mark.parametrize("arrival", [False, True])
def test_alert_job_over_a_backlog(spark, tmp_path, arrival):
    """The job as it is started: the alerts of the batch twin, refused messages and raw log kept."""
    from tallyline import __main__ as jobs

    backlog(tmp_path / "topic", arrival=arrival)
    given = ["alerts", "--store", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "cp"), "--path", str(tmp_path / "topic"), "--raw-log"]
    given += ["--format", "json", "--schema", "value string, timestamp timestamp", "--time-basis", "arrival"] if arrival else ["--format", "text"]
    for query in jobs.start_alert_job(spark, jobs.parser().parse_args(given)):
        query.awaitTermination()
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    twin = spark.createDataFrame([(i, 1704067200 + i, "007") for i in range(500)], "ident long, t long, district string")
    seconds = trailing.per_second(twin.withColumn("moment", F.timestamp_seconds("t")), "district", "moment", "ident")
    expected = alerts.alert_rows(alerts.anomaly_rows(trailing.trailing_emits(seconds, 300, 60), "key"))
    shown = ["alert_id", "event_count", "severity"]
    got = store.alerts.latest(shape_alerts(spark)).select(*shown).collect()
    assert len(got) == 8 and sorted(map(tuple, got)) == sorted(map(tuple, expected.select(*shown).collect()))
    assert sorted(r["reject_reason"] for r in spark.read.json(str(tmp_path / "out" / "quarantine")).collect()) == ["missing_date", "not_json"]
    assert spark.read.parquet(str(tmp_path / "out" / "raw_events")).count() == 500


def test_late_rows_are_counted(spark, tmp_path):
    base = 1704067200
    write_topic(tmp_path / "topic", [(0, base, "7"), (1, base + 9000, "7"), (2, base + 9001, "7"), (3, base, "7")], 0, 1)
    counts = windows.hop_stream(stream(spark, tmp_path / "topic"), "district", "moment", SIZE, SIZE, "10 seconds")
    target = sinks.BatchTable(spark, str(tmp_path / "hops"), ("district", "window_start", "window_end"), "window_start")
    query = sinks.start_batches(counts, target.upsert, str(tmp_path / "cp"), "update")
    query.awaitTermination()
    assert windows.late_rows(query) == 1


def emits_with(spark, folder, late):
    return windows.trailing_stream(stream(spark, folder), "district", "moment", "ident", SIZE, SLIDE, late)


def kept_keys(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_idle_keys_leave_the_state(spark, tmp_path):
    """Keys that do not come back are forgotten when the watermark has passed what they can matter for."""
    base = 1704067200
    rows = [(i, base + i, str(i % 7)) for i in range(14)] + [(50 + i, base + 2000 + 400 * i, "9") for i in range(6)]
    write_topic(tmp_path / "topic", rows, 0, 2)
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    query = sinks.start_alerts(emits_with(spark, tmp_path / "topic", "100 seconds"), store, str(tmp_path / "cp"), minima=MINIMA, threshold=4)
    query.awaitTermination()
    held = kept_keys(query)
    assert max(held) >= 7 and held[-1] <= 1
    assert live_counts(spark, store) == expected_counts(spark, tmp_path / "topic")


def test_state_goes_on_after_a_restart_and_forgets(spark, tmp_path):
    rows = made_events(300)
    folder, store = tmp_path / "topic", sinks.AlertStore(spark, str(tmp_path / "out"))
    for number, part in enumerate((rows[:150], rows[150:])):
        write_topic(folder, part, 10 * number, 50)
        query = sinks.start_alerts(emits_with(spark, folder, "30 seconds"), store, str(tmp_path / "cp"), minima=MINIMA, threshold=4)
        query.awaitTermination()
    assert live_counts(spark, store) == expected_counts(spark, folder)


def test_row_of_a_forgotten_key_is_not_counted(spark, tmp_path):
    """Behind the watermark, with the state gone: no emit, and no state made for it."""
    base = 1704067200
    rows = [(0, base, "7"), (1, base + 9000, "8"), (2, base + 9001, "8"), (3, base + 10, "7"), (4, base + 9100, "8")]
    write_topic(tmp_path / "topic", rows, 0, 1)
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    sinks.start_alerts(emits_with(spark, tmp_path / "topic", "10 seconds"), store, str(tmp_path / "cp"), minima=MINIMA, threshold=4).awaitTermination()
    assert [(d, end - base, n) for d, end, n in live_counts(spark, store)] == [("007", 0, 1), ("008", 9000, 1), ("008", 9100, 3)]


def test_late_rows_and_rows_on_time_are_all_rows(spark, tmp_path):
    base = 1704067200
    rows = [(i, base + 60 * i, "7") for i in range(40)] + [(100 + i, base + i, "8") for i in range(5)] + [(200, base + 2401, "7"), (201, base + 2339, "7")]
    write_topic(tmp_path / "topic", rows, 0, 10)
    marked = windows.marked_late(stream(spark, tmp_path / "topic").select("ident", "district", "moment"), "moment", "60 seconds")
    counts = sinks.BatchTable(spark, str(tmp_path / "on-time"), ("district", "window_start"), "window_start")
    given = (marked, counts, str(tmp_path / "late"), str(tmp_path / "cp"), "district", "moment", SIZE, SIZE)
    sinks.start_late_split(*given).awaitTermination()
    shape = spark.createDataFrame([], "district string, window_start timestamp, window_end timestamp, event_count long")
    late = sorted(r["ident"] for r in spark.read.json(str(tmp_path / "late")).collect())
    on_time = sinks.summed_parts(counts, shape)
    # The last file comes under a watermark of 60 seconds before the newest of the files before it.
    assert late == [100, 101, 102, 103, 104]
    assert on_time.agg(F.sum("event_count")).first()[0] + len(late) == len(rows)
    twin = hops.hop_counts(batch(spark, tmp_path / "topic").where(~F.col("ident").isin(late)), "district", "moment", SIZE, SIZE)
    assert on_time.exceptAll(twin).count() == 0 and twin.exceptAll(on_time).count() == 0


def test_marked_names_are_kept(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    with pytest.raises(ValueError, match="late"):
        windows.marked_late(stream(spark, tmp_path / "topic").withColumn("Late", F.lit(1)), "moment", "1 minute")


def test_copies_are_told_in_the_stream(spark, tmp_path):
    """Doubled events in one micro-batch, across micro-batches and after a restart come out once."""
    rows = made_events(120)
    folder = tmp_path / "topic"
    target = sinks.BatchTable(spark, str(tmp_path / "once"), ("case_number",), "moment")
    for number, part in enumerate((rows[:60] + rows[:60], rows[30:] + rows[:10])):
        write_topic(folder, part, 10 * number, 30)
        once = windows.once_within(stream(spark, folder).select("case_number", "moment"), ["case_number"], "moment", "10 days")
        sinks.start_batches(once, target.upsert, str(tmp_path / "cp")).awaitTermination()
    got = target.stored(spark.createDataFrame([], once.schema)).collect()
    assert sorted(int(r["case_number"]) for r in got) == list(range(120))


def test_expiry_drops_days_and_old_rows(spark, tmp_path):
    log = sinks.raw_log(spark, str(tmp_path / "log"))
    stamps = [0, 40_000, 86_400, 90_000, 100_000, 172_800, 180_000]
    rows = spark.createDataFrame([(f"e{s}", s) for s in stamps], "event_id string, s long").withColumn("ingested_at", F.timestamp_seconds("s"))
    for batch, seconds in enumerate(([0, 86_400], [40_000, 90_000, 100_000], [172_800, 180_000])):
        log.upsert(rows.where(F.col("s").isin(seconds)), batch, "q")
    begun = log.stored(rows)  # a reader of the newest day, begun before
    newest = begun.where("day = '1970-01-03'")
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "log" / "day=1970-01-03").rglob("*.parquet")}
    for _ in range(2):
        log.expire(datetime.fromtimestamp(95_000, timezone.utc))
        assert sorted(r["s"] for r in log.stored(rows).collect()) == [100_000, 172_800, 180_000]
        assert not (tmp_path / "log" / "day=1970-01-01").exists()
    assert newest.count() == 2 and untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "log" / "day=1970-01-03").rglob("*.parquet")}
    log.upsert(rows.where("s = 180000").withColumn("event_id", F.lit("new")), 3, "q")  # the writer goes on
    assert log.stored(rows).count() == 4
    for _ in range(2):  # the edge day has nothing to keep
        log.expire(datetime.fromtimestamp(180_001, timezone.utc))
        assert log.stored(rows).count() == 0
    log.expire(datetime.fromtimestamp(10 * 86_400, timezone.utc))
    assert log.stored(rows).count() == 0 and log.days() == []


def test_topic_files_are_even_and_in_time_order(spark):
    """All files of the fixture by one job, crowded seconds dealt out, times of change in order."""
    import os

    from tallyline.bindings import streams as fixture

    folder = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    path = Path(fixture._topic(spark, folder).removeprefix("file:"))
    files = sorted(path.glob("part-*.txt"), key=lambda p: p.stat().st_mtime)
    dates = [[json.loads(x)["date"] for x in p.read_text().splitlines()] for p in files]
    assert len(files) == fixture.FEEDS and all(dates)
    assert all(max(a) <= min(b) for a, b in zip(dates, dates[1:], strict=False))
    assert max(map(len, dates)) <= 2 * sum(map(len, dates)) / len(dates)


def test_topic_makes_each_line_once(spark, monkeypatch):
    """Spark looks for the borders of the ranges in plain rows, not in the lines."""
    import os

    from tallyline.bindings import streams as fixture

    folder = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    made = spark.sparkContext.accumulator(0)

    def as_line(date):
        made.add(1)
        return date

    whole = F.date_format
    monkeypatch.setattr(F, "date_format", lambda *given: F.udf(as_line, "string")(whole(*given)))
    fixture._topic(spark, folder)
    assert made.value == spark.read.parquet(f"{folder}/events.parquet").count()


@pytest.mark.parametrize("name", ["stream_alerts", "stream_counts", "stream_dedupe", "stream_arrival", "stream_live_summary", "stream_hop_counts"])
def test_micro_batches_do_not_grow_with_the_events(spark, monkeypatch, name):
    """Many files of few events: a micro-batch takes an eighth of them, not one."""
    import os

    from tallyline.bindings import streams as fixture
    from tallyline.session import folder_names

    folder = os.environ.get("TALLYLINE_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")

    class Begun(Exception):
        pass

    def taken(spark, fmt, path, schema=None, **options):
        raise Begun(len(folder_names(spark, path, "part-")), int(options["maxFilesPerTrigger"]))

    monkeypatch.setattr(fixture, "FEED_ROWS", 20)
    monkeypatch.setattr(events, "read_event_stream", taken)
    with pytest.raises(Begun) as begun:
        getattr(fixture, name)(spark, folder)
    files, together = begun.value.args
    assert files > 2 * fixture.FEEDS and -(-files // together) <= fixture.FEEDS


def test_state_has_no_more_partitions_than_the_cluster_cores(spark, topic, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
    try:
        for name, width in (("cores", None), ("two", 2)):
            counts = windows.hop_stream(stream(spark, topic, 9), "district", "moment", SIZE, SLIDE, "60 days")
            target = sinks.BatchTable(spark, str(tmp_path / name), ("district", "window_start", "window_end"), "window_start")
            sinks.start_batches(counts, target.upsert, str(tmp_path / f"cp-{name}"), "update", width=width).awaitTermination()
            made = {p.name for p in (tmp_path / f"cp-{name}" / "state" / "0").iterdir() if p.name.isdigit()}
            assert len(made) == (width or cores)
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(3 * cores)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_summary_of_the_running_stream(spark, tmp_path):
    """Each micro-batch is put down once, whether the listener or the end of the query tells of it."""
    folder = tmp_path / "topic"
    write_topic(folder, made_events(160), 0, 40)
    (folder / "zz.txt").write_text('oops\n{"case_number": "1"}\n')
    watched = summary.StreamSummary(spark, str(tmp_path / "summary"))
    assert watched.batches().count() == 0 and watched.totals().first()["rows_processed"] == 0
    lines = events.read_event_stream(spark, "text", str(folder), maxFilesPerTrigger="1")
    good = timed(events.accepted(summary.observed_intake(events.parse_events(lines))))
    emits = summary.observed_emits(windows.trailing_stream(good, "district", "moment", "ident", SIZE, SLIDE), MINIMA)
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    spark.streams.addListener(watched)
    try:
        query = sinks.start_alerts(emits, store, str(tmp_path / "cp"), minima=MINIMA, threshold=4)
        query.awaitTermination()
        watched.settle(query)
        watched.settle(query)
    finally:
        spark.streams.removeListener(watched)
    rows = watched.batches().where("rows_processed > 0").collect()
    assert len(rows) == 5 and sum(r["rows_processed"] for r in rows) == 162
    expected = alerts.anomaly_rows(batch_emits(spark, folder), "key", MINIMA, 4).collect()
    total = watched.totals().first()
    assert (total["rows_rejected"], total["windows_emitted"], total["rows_late"]) == (2, len(expected), 0)
    assert total["anomalies_detected"] == sum(r["severity"] is not None for r in expected)


def test_page_of_alerts_reads_the_days_written_last(spark, tmp_path):
    """However many alerts are stored, the page opens the folders of the newest days of writing only."""
    store = sinks.AlertStore(spark, str(tmp_path / "out"))
    shape = shape_alerts(spark)
    for day in range(12):
        stamped = [(f"a{day}-{k}", day) for k in range(3)]
        rows = spark.createDataFrame(stamped, "alert_id string, d int").select(
            "alert_id", F.lit("007").alias("district"), F.timestamp_seconds(F.col("d") * 86400 + 5).alias("alert_timestamp"),
            F.timestamp_seconds(F.lit(0)).alias("window_start"), F.timestamp_seconds(F.lit(300)).alias("window_end"),
            F.lit(9).cast("long").alias("event_count"), F.lit(4).cast("long").alias("threshold_value"), F.lit("HIGH").alias("severity"),
            F.lit("m").alias("message"), F.lit("s").alias("source"),
        )
        store.recent.upsert(rows, day, "q")
    page = store.page(shape, 4)
    assert sorted(r["alert_id"] for r in page.collect()) == [f"a{d}-{k}" for d in (10, 11) for k in range(3)]
    assert {p.split("day=")[1][:10] for p in page.inputFiles()} == {"1970-01-11", "1970-01-12"}
    assert store.page(shape, 10**6).count() == 36
    assert sinks.AlertStore(spark, str(tmp_path / "none")).page(shape, 4).count() == 0

"""Large CSV files by many tasks: the same rows as the whole-file scan, whatever the splits."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.sources import records, splitcsv

SCHEMA = StructType([StructField(n, StringType()) for n in ("a", "b`b", "c")])
BYTES = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def tiny_splits(spark):
    names = (BYTES, "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(BYTES, "700")
    spark.conf.set(names[1], "10")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def fields(draw):
    return draw.choice(
        ["plain", "", 'say "x"', "two\nlines", "a,b", '"', '"""', "\n", 'end"\n', "é日本", " padded ", "x" * draw.randrange(60), "line\n" * draw.randrange(40), "\r\n", "5' 3"]
    )


def write(path, rows, ending="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=ending, quoting=quoting)
        writer.writerow(["A", "B\nB", "C"])
        writer.writerows(rows)


def shown(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def whole(spark, path):
    return spark.read.schema(SCHEMA).options(header=True, mode="PERMISSIVE", multiLine=True, escape='"').csv(path)


def drawn_rows(draw):
    rows = [[fields(draw) for _ in range(3)] for _ in range(400)]
    rows.append(["big", "long\n" * 900, "tail"])  # one record over several splits
    return rows + [[fields(draw) for _ in range(3)] for _ in range(50)]


def test_other_line_ends(spark, tmp_path, tiny_splits):
    """Carriage returns before line ends go, those inside fields stay as they were written."""
    rows = drawn_rows(random.Random(3))
    write(tmp_path / "f.csv", rows, "\r\n")
    wanted = sorted((tuple(cell or None for cell in row) for row in rows), key=str)
    assert shown(splitcsv.scan_split(spark, str(tmp_path), SCHEMA)) == wanted


@pytest.mark.parametrize("seed, quoting", [(1, csv.QUOTE_MINIMAL), (2, csv.QUOTE_ALL)])
def test_rows_equal_the_whole_file_scan(spark, tmp_path, tiny_splits, seed, quoting):
    draw = random.Random(seed)
    for number in range(2):
        write(tmp_path / f"part-{number}.csv", drawn_rows(draw), "\n", quoting)
    made = splitcsv.scan_split(spark, str(tmp_path), SCHEMA)
    assert made.columns == SCHEMA.names
    got, wanted = shown(made), shown(whole(spark, str(tmp_path)))
    assert len(got) == 902 and got == wanted


def test_ragged_rows_and_stray_quotes(spark, tmp_path, tiny_splits):
    lines = ["A,B,C", "1,2", "1,2,3,4", '5" pipe,x,y', '"q","r"', "", "last,row,here"] * 30
    (tmp_path / "f.csv").write_text("\n".join(lines), encoding="utf-8")
    got, wanted = shown(splitcsv.scan_split(spark, str(tmp_path), SCHEMA)), shown(whole(spark, str(tmp_path)))
    assert got == wanted and len(got) == 30 * 6 - 1


def test_no_rows(spark, tmp_path):
    write(tmp_path / "f.csv", [])
    assert splitcsv.scan_split(spark, str(tmp_path), SCHEMA).count() == 0
    (tmp_path / "f.csv").write_text("")
    assert splitcsv.scan_split(spark, str(tmp_path), SCHEMA).count() == 0


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_splits):
    """The plain entry takes the split scan where a file is larger than a split."""
    write(tmp_path / "f.csv", [[str(k), "a\nb", "c"] for k in range(300)])
    made = records.scan_csv(spark, str(tmp_path / "f.csv"), SCHEMA)
    tasks = made.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 3 and made.count() == 300
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(BYTES, "128m")
    plan = records.scan_csv(spark, str(tmp_path / "f.csv"), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "FileScan csv" in plan


def test_other_splits_than_looked_through_are_refused(spark, tmp_path, tiny_splits):
    write(tmp_path / "f.csv", [[str(k), "a\nb", "c"] for k in range(300)])
    made = splitcsv.scan_split(spark, str(tmp_path / "f.csv"), SCHEMA)
    spark.conf.set(BYTES, "500")
    with pytest.raises(Exception, match="split otherwise"):
        made.select("a").distinct().collect()


@pytest.mark.parametrize(
    "line, outside, inside",
    [("a,b", False, True), ('"a,b', True, False), ('a"', False, False), ('"a""",b', False, True), ('x,"', True, False), ('""', False, True), ('"""', True, False), ('a,5" p', False, False)],
)
def test_effect_of_a_line(line, outside, inside):
    assert (splitcsv.leaves_inside(line, False), splitcsv.leaves_inside(line, True)) == (outside, inside)


@pytest.mark.parametrize("size", [("100", 100), ("4k", 4096), ("128m", 1 << 27), ("1g", 1 << 30), ("134217728b", 1 << 27), ("2kb", 2048)])
def test_split_bytes(spark, size):
    before = spark.conf.get(BYTES)
    try:
        spark.conf.set(BYTES, size[0])
        assert records.split_bytes(spark) == size[1]
    finally:
        spark.conf.set(BYTES, before)


def test_texts_are_written_and_scanned_by_many_tasks(spark, tmp_path, monkeypatch):
    """The query's files are made side by side, none by a task that reads all texts."""
    from tallyline.bindings import cleaning

    made = []
    monkeypatch.setattr(cleaning, "scratch_path", lambda spark, label: made.append(str(tmp_path / label)) or made[-1])
    text = F.concat(F.lit('say "'), F.col("id").cast("string"), F.lit('",\nthen '), F.repeat(F.lit("go\n"), 4000))
    rows = spark.range(120, numPartitions=3).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source")
    )
    rows.write.parquet(str(tmp_path / "tables" / "documents.parquet"))
    found = {r["doc_id"]: (r["chars"], r["digest"]) for r in cleaning.csv_scan_split(spark, str(tmp_path / "tables")).collect()}
    wanted = rows.select(F.col("doc_id").cast("string"), F.length("text"), F.md5("text")).collect()
    assert found == {d: (n, digest) for d, n, digest in wanted} and len(wanted) == 120
    assert len(list((tmp_path / "documents-split-csv").glob("part-*"))) == 3


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_records_of_a_line_each_are_read_by_lines(spark, tmp_path, tiny_splits):
    """No Python and only the columns asked for where the look through finds a record on every line."""
    draw = random.Random(5)
    rows = [[draw.choice(["x", "", " padded ", "a 'b'", "é日本", 'say "x"']) for _ in range(3)] for _ in range(300)]
    with open(tmp_path / "f.csv", "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([["A", "B", "C"], *rows])
        file.write('\n\n1,2\n1,2,3,4\n"q" x,"r",""\n')
    made = splitcsv.scan_split(spark, str(tmp_path), SCHEMA)
    assert "MapInArrow" not in plan_of(made) and made.rdd.getNumPartitions() > 3
    assert shown(made) == shown(whole(spark, str(tmp_path))) and made.count() == 303
    assert "struct<a:string>" in plan_of(made.select("a"))


@pytest.mark.parametrize("odd", ['a,"b\nc",d\n', "a,b\r\n", "a,b,c\n \t\n", '"a,b",c,d\n'])
def test_one_other_line_keeps_the_split_scan(spark, tmp_path, tiny_splits, odd):
    (tmp_path / "f.csv").write_bytes(("A,B,C\n" + '1,"2",3\n' * 200 + odd + '1,"2",3\n' * 200).encode())
    made = splitcsv.scan_split(spark, str(tmp_path), SCHEMA)
    assert "MapInArrow" in plan_of(made)
    assert sum(row == ("1", "2", "3") for row in shown(made)) == 400


def test_even_lines_are_left_as_they_are_entered():
    import pyarrow as pa
    import pyarrow.compute as pc

    draw = random.Random(7)
    lines = ["".join(draw.choice('",a ') for _ in range(draw.randrange(9))) for _ in range(3000)]
    even = pc.match_substring_regex(pa.array(lines), splitcsv.EVEN).to_pylist()
    for line, same in zip(lines, even, strict=True):
        assert same == all(piece.count('"') % 2 == 0 for piece in line.split(","))
        assert not same or [splitcsv.leaves_inside(line, at) for at in (False, True)] == [False, True]
    assert 300 < sum(even) < 2700

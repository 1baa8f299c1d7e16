"""CSV files with line breaks in quoted fields, read by many tasks, against the one-task read."""

import csv
import random

import pytest

from propensa.sources import csv_io, csv_records

TYPES = {"clinician_id": "varchar", "note": "varchar", "n": "bigint"}


def written(path, rows, end="\n", header=True):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        if header:
            w.writerow(TYPES)
        w.writerows(rows)
    return str(path)


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of a few records."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def some_rows(rnd, n):
    notes = ["plain", "", 'a "quoted" word', "two\nlines", '"', '""', "\n\n\n", ",;,", " padded ", 'x\n"y"\nz', "long " * 40, "line\n" * 30, "é 你好\n"]
    return [(f"CLN_{i:05d}", rnd.choice(notes), rnd.choice([i, -i, ""])) for i in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one_task(spark, path):
    schema = csv_io.schema_from_types(TYPES)
    return spark.read.option("header", "true").option("multiLine", "true").options(**csv_io._KEEP_SPACES).schema(schema).csv(path)


@pytest.mark.parametrize("size", [40, 97, 500, 1 << 20])
def test_ranges_give_the_records_of_one_task(spark, tmp_path, small_ranges, size):
    rnd = random.Random(size)
    rows = some_rows(rnd, 300)
    path = written(tmp_path / "a.csv", rows)
    want = rows_of(one_task(spark, path))
    small_ranges(size)
    got = csv_io.read_csv(spark, path, TYPES, multiline=True)
    assert rows_of(got) == want and len(want) == 300
    ranges = csv_records.lines_of(spark, path).select("start").distinct().count()
    assert ranges > 100 if size <= 97 else ranges >= 1


def test_a_field_over_many_ranges(spark, tmp_path, small_ranges):
    rows = [("a", "x\n" * 400 + '"end"', 1), ("b", "short", 2), ("c", '\n"\n' * 100, 3), ("d", "y" * 500, 4)]
    path = written(tmp_path / "a.csv", rows)
    small_ranges(64)
    lines = csv_records.lines_of(spark, path)
    states, headers = csv_records.range_states(lines)
    assert sum(next(iter(states.values())).values()) > 10 and headers == {"clinician_id,note,n"}
    kinds = {r.kind for r in csv_records.range_records(lines, states).select("kind").distinct().collect()}
    assert kinds >= {csv_records.HEAD, csv_records.MIDDLE, csv_records.TAIL}
    assert rows_of(csv_io.read_csv(spark, path, TYPES, multiline=True)) == rows


def test_several_files_line_ends_and_empty_ones(spark, tmp_path, small_ranges):
    folder = tmp_path / "d"
    folder.mkdir()
    rnd = random.Random(1)
    parts = [some_rows(rnd, n) for n in (50, 0, 1, 120)]
    for i, rows in enumerate(parts):
        written(folder / f"p{i}.csv", rows)
    (folder / "empty.csv").write_text("")
    want = rows_of(one_task(spark, str(folder)))
    small_ranges(80)
    assert rows_of(csv_io.read_csv(spark, str(folder), TYPES, multiline=True)) == want and len(want) == 171
    crlf = written(tmp_path / "w.csv", [("a", "x", 1), ("b", "two\nlines", 2)], end="\r\n")
    assert rows_of(csv_io.read_csv(spark, crlf, TYPES, multiline=True)) == [("a", "x", 1), ("b", "two\nlines", 2)]
    (tmp_path / "g.csv").write_text("clinician_id,note,n\n\na,x,1\n\n\nb,y,2")
    assert rows_of(csv_io.read_csv(spark, str(tmp_path / "g.csv"), TYPES, multiline=True)) == [("a", "x", 1), ("b", "y", 2)]


def test_broken_files_fail(spark, tmp_path):
    read = lambda: csv_io.read_csv(spark, str(tmp_path / "a.csv"), TYPES, multiline=True).collect()
    for text in ('clinician_id,note,n\na,"open,1\n', "clinician_id,other,n\na,x,1\n", "clinician_id,note,n\na,x,abc\n", "clinician_id,note,n\na\n"):
        (tmp_path / "a.csv").write_text(text)
        spark.catalog.clearCache()
        with pytest.raises(Exception):
            read()


def test_changed_ranges_are_noticed(spark, tmp_path, small_ranges):
    path = written(tmp_path / "a.csv", some_rows(random.Random(2), 100))
    small_ranges(200)
    lines = csv_records.lines_of(spark, path)
    states, _ = csv_records.range_states(lines)
    small_ranges(300)
    with pytest.raises(Exception, match="differ between two scans"):
        csv_records.range_records(csv_records.lines_of(spark, path), states).collect()

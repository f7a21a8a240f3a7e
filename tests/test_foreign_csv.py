"""Multi-line CSV read in splits equals a whole-file read."""

import csv
import random

import pytest

from tessera.sources import csv_io, foreign_csv


def write(path, rows, ends="\n", header=("a", "b`c", "d")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=ends)
        w.writerows([header, *rows])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cells(seed, n):
    r = random.Random(seed)
    parts = ["x", "é漢", '"', '""', ",", "\n", "\n\n", " ", "'", "\\", '"\n', "long " * 30, "🙂"]
    return [tuple("".join(r.choice(parts) for _ in range(r.randrange(6))) for _ in range(2)) + (str(i),) for i in range(n)]


@pytest.mark.parametrize("ends, broadcast_splits", [("\n", 1000), ("\r\n", 1000), ("\n", 0)])
def test_equals_the_whole_file_read_and_the_rows(spark, tmp_path, small_splits, ends, broadcast_splits):
    (tmp_path / "in").mkdir()
    rows = cells(1, 150), cells(2, 90), [("", "", "only")], []
    for k, part in enumerate(rows):
        write(tmp_path / "in" / f"{k}.csv", part, ends)
    columns = ["a", "b`c", "d"]
    got = foreign_csv.read_foreign_csv(spark, str(tmp_path / "in"), columns, "seq", broadcast_splits).na.fill("").orderBy("seq").collect()
    assert [tuple(r)[:3] for r in got] == [x for part in rows for x in part]
    assert len({r["seq"] for r in got}) == len(got)
    opts = dict(csv_io._READ_OPTS)
    want = spark.read.schema(csv_io.all_string_schema(columns)).options(**opts).csv(str(tmp_path / "in")).na.fill("").collect()
    assert sorted(tuple(r) for r in want) == sorted(tuple(r)[:3] for r in got)


def test_is_read_in_splits(spark, tmp_path, small_splits):
    write(tmp_path / "one.csv", cells(3, 200))
    lines = foreign_csv._lines(spark, str(tmp_path / "one.csv"))
    assert lines.select("_block").distinct().count() > 10
    assert foreign_csv._split_states(lines).where("entry = 1").count() > 0       # borders inside cells are met


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    long = ('line "quoted"\n' * 600) + "end"
    write(tmp_path / "one.csv", [("1", long, "x"), ("2", "\n" * 900, ""), ("3", "", long)])
    got = foreign_csv.read_foreign_csv(spark, str(tmp_path / "one.csv"), ["a", "b", "c"]).na.fill("").collect()
    assert sorted(tuple(r) for r in got) == [("1", long, "x"), ("2", "\n" * 900, ""), ("3", "", long)]


def test_short_long_and_empty_records(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1\n\n2,"x\n\ny"\n3,4,5\n"",""\n,\nlast,no end')
    got = csv_io.read_text_csv(spark, str(tmp_path / "one.csv"), ["a", "b"], parallel=True).collect()
    want = csv_io.read_text_csv(spark, str(tmp_path / "one.csv"), ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(got) == 6


def test_odd_quotes_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"x\n')
    with pytest.raises(ValueError, match="bad.csv"):
        foreign_csv.read_foreign_csv(spark, str(tmp_path / "bad.csv"), ["a", "b"])
    (tmp_path / "none.csv").write_text("")
    assert foreign_csv.read_foreign_csv(spark, str(tmp_path / "none.csv"), ["a"]).collect() == []
    (tmp_path / "head.csv").write_text("a,b\n")
    assert foreign_csv.read_foreign_csv(spark, str(tmp_path / "head.csv"), ["a", "b"], "seq").collect() == []

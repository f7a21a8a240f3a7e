"""Replies collected per item while they arrive."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.enrich import MISSING_PAGE_TEXT
from tessera.streaming import fan_in_stream as fs

NOTE = MISSING_PAGE_TEXT


def at(second):
    return f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}"


@pytest.fixture
def load(spark, tmp_path):
    """Loads of events, each handled by a query of its own with the same checkpoint."""
    def run(*events):
        rows = [(i, n, p, t, at(s)) for i, n, p, t, s in events]
        (spark.createDataFrame(rows, "item long, names array<string>, pos int, text string, at string")
         .withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events"))
        stream = spark.readStream.schema(fs.EVENTS).parquet(f"{tmp_path}/events")
        fs.run_available(stream, f"{tmp_path}/items", f"{tmp_path}/checkpoint", wait_ms=60_000)
        return sorted((r["item"], [tuple(x) for x in r["list"]], r["n_missing"])
                      for r in spark.read.parquet(f"{tmp_path}/items").collect())
    return run


def test_replies_before_after_and_never(load):
    got = load((1, ["a", "b"], None, None, 0), (1, None, 1, "B", 1), (2, [], None, None, 2), (3, None, 0, "C", 3),
               (4, ["d"], None, None, 4), (5, None, None, None, 5), (None, ["x"], None, None, 5), (6, None, 0, "orphan", 5))
    assert got == [(2, [], 0), (5, [], 0)]                                  # item 1 waits, 3 has no list yet
    got = load((1, None, 0, "A", 30), (3, ["c"], None, None, 31), (4, None, 9, "no such place", 32), (1, None, 1, "late", 33))
    assert got[:1] == [(1, [("a", "A"), ("b", "B")], 0)] and [x[0] for x in got] == [1, 2, 3, 5]
    got = load((-1, None, 0, None, 600))                                    # the watermark passes item 4's deadline
    assert [x for x in got if x[0] == 4] == [(4, [("d", NOTE)], 1)] and len(got) == 5
    assert load((4, None, 0, "too late", 601), (-2, None, 0, None, 3000)) == got    # emitted once; orphans are forgotten


def test_least_text_empty_replies_and_second_items(load):
    got = load((1, ["a", None], None, None, 0), (1, None, 0, "z", 1), (1, None, 0, "y", 2), (1, ["other"], None, None, 3),
               (1, None, 1, None, 4))
    assert got == [(1, [("a", "y"), (None, NOTE)], 0)]


def test_an_item_that_comes_past_its_deadline(load):
    load((1, [], None, None, 3000))
    assert (2, [("b", NOTE)], 1) in load((2, ["b"], None, None, 3001), (-1, None, 0, None, 3500))


def test_items_of_one_bucket_keep_their_own_deadlines(spark, tmp_path):
    def load(*events):
        rows = [(i, n, p, t, at(s)) for i, n, p, t, s in events]
        (spark.createDataFrame(rows, "item long, names array<string>, pos int, text string, at string")
         .withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events"))
        stream = spark.readStream.schema(fs.EVENTS).parquet(f"{tmp_path}/events")
        fs.run_available(stream, f"{tmp_path}/items", f"{tmp_path}/checkpoint", wait_ms=60_000, buckets=1)
        return sorted((r["item"], [tuple(x) for x in r["list"]], r["n_missing"])
                      for r in spark.read.parquet(f"{tmp_path}/items").collect())

    late = [(i, [f"n{i}"], None, None, 40) for i in range(10, 15)]
    assert load((1, ["a"], None, None, 0), (2, ["b"], None, None, 30), (3, ["c"], None, None, 0), (3, None, 0, "C", 1),
                *late) == [(3, [("c", "C")], 0)]
    got = load((2, None, 0, "B", 61))                   # item 1's deadline is passed, not those of the others
    assert [x for x in got if x[0] < 10] == [(1, [("a", NOTE)], 1), (2, [("b", "B")], 0), (3, [("c", "C")], 0)] and len(got) == 3
    got = load((-1, None, 0, None, 101))
    assert [x for x in got if x[0] >= 10] == [(i, [(f"n{i}", NOTE)], 1) for i in range(10, 15)]

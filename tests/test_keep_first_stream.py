"""Keep-first over a stream: any split of the input into batches gives the
rows of one keep-first over all of it."""

import random

import pytest

from tessera.operators import dedup
from tessera.session import scratch_path
from tessera.streaming import keep_first_stream as ks

SCHEMA = "k string, seq long, v string"


def _run(spark, root, schema):
    events = spark.readStream.schema(schema).parquet(f"{root}/in/*")
    ks.start_keep_first(events, f"{root}/out", "k", "seq", f"{root}/ckpt").awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_same_rows(spark, seed):
    rng = random.Random(seed)
    root = scratch_path(spark, f"keep-first-{rng.random()}-{random.random()}")
    seqs = list(range(60))
    rng.shuffle(seqs)                                               # batches come out of order
    rows = [(rng.choice([None, "", "a", "b", f"x{s % 20}"]), s, f"v{s}") for s in seqs]
    rows += rows[:5]                                                # repeated rows
    frame = spark.createDataFrame(rows, SCHEMA)
    assert ks.read_kept(spark, f"{root}/out", frame.schema, "k", "seq").count() == 0
    cuts = sorted(rng.sample(range(1, len(rows)), 2))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], SCHEMA).write.parquet(f"{root}/in/b{i}")
        _run(spark, root, frame.schema)                             # a new query each time: restarts from its checkpoint
        got = ks.read_kept(spark, f"{root}/out", frame.schema, "k", "seq")
        want = dedup.keep_first(spark.createDataFrame(rows[:b], SCHEMA), "k", "seq")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_batch_hands_on_what_it_changed(spark):
    root = scratch_path(spark, f"keep-first-{random.random()}")
    first = spark.range(100).selectExpr("concat('k', id % 10) k", "id + 100 seq", "'old' v")
    later = spark.createDataFrame([("k3", 5, "new")], SCHEMA)
    for i, df in enumerate((first, later)):
        df.coalesce(1).write.parquet(f"{root}/in/b{i}")
        _run(spark, root, later.schema)
    changes = spark.read.parquet(f"{root}/out").groupBy("batch").count().collect()
    assert sorted(r["count"] for r in changes)[-1] == 10 and min(r["count"] for r in changes) == 1
    kept = ks.read_kept(spark, f"{root}/out", later.schema, "k", "seq")
    assert kept.count() == 10 and kept.where("v = 'new'").collect()[0]["seq"] == 5

"""Bucketed collections: the merge equals the plain one and leaves the base
where it is."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import merge
from tessera.session import scratch_path
from tessera.sources import bucketed

SCHEMA = "numero long, nome string, a long, b array<string>"


def _rows(rng, n, keys=9):
    pick = lambda *xs: rng.choice(xs)
    return [(pick(None, rng.randrange(keys)), pick(None, "x", "y", "z", ""), pick(None, 0, 1), pick(None, [], ["p"]))
            for _ in range(n)]


def _sorted(df):
    return sorted(map(repr, df.select("numero", "nome", "a", "b", "op").collect()))


@pytest.mark.parametrize("seed", range(4))
def test_batches_equal_the_plain_merge(spark, seed):
    rng = random.Random(seed)
    root = scratch_path(spark, f"bucketed-{seed}-{rng.random()}")
    rows = _rows(rng, 14 * (seed > 0), 5)                # keys and rows repeat; empty for seed 0
    if seed < 3:                                         # several batches: a copy once patched stays the patched one here
        rows = [r for i, r in enumerate(rows) if r[0] is None or r[0] not in {x[0] for x in rows[:i]}]
    plain = spark.createDataFrame(rows, SCHEMA)
    bucketed.load(plain, root, "numero", "nome", 4)
    for size in (12, 0, 9) if seed < 3 else (20,):
        batch = spark.createDataFrame([(*r, i) for i, r in enumerate(_rows(rng, size))], SCHEMA + ", seq long")
        want = merge.upsert(plain, batch, "numero", "nome", "seq")
        bucketed.upsert(spark, root, batch, "seq")
        got = bucketed.read(spark, root)
        assert _sorted(got) == _sorted(want)
        plain = spark.createDataFrame(want.drop("op").collect(), SCHEMA)


def test_base_is_not_shuffled(spark):
    root = scratch_path(spark, f"bucketed-{random.random()}")
    docs = spark.range(5000).selectExpr("IF(id % 3 = 0, NULL, id) numero", "concat('n', id % 50) nome", "id a", "array('p') b")
    bucketed.load(docs, root, "numero", "nome", 8)
    batch = spark.range(60).selectExpr("IF(id % 2 = 0, id, NULL) numero", "concat('n', id) nome", "id a", "array('q') b", "id seq")
    base = bucketed._stored(spark, root)
    assert base.groupBy(F.expr("pmod(hash(_id), 8)")).count().where("count > 1250").count() == 0      # key-less rows spread
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bucketed.merged(base, batch, "numero", "nome", "seq", "9")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
    whole = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "_salt" not in x.split("ReadSchema")[0].split("[")[1]]
    scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x]
    assert len(scans) == 2 and len(whole) <= 2
    for i in scans:                                   # from a scan up to its first join: no exchange
        at, d = i, depth(lines[i])
        while "Join" not in lines[at]:
            at -= 1
            if depth(lines[at]) < d:
                d = depth(lines[at])
                assert "Exchange" not in lines[at], plan
    assert all("Bucketed: true" in lines[i] for i in scans)


def test_version_is_read_by_a_session_that_did_not_write_it(spark):
    root = scratch_path(spark, f"bucketed-{random.random()}")
    docs = spark.createDataFrame([(1, "x", 1, ["p"]), (None, "x", 2, [])], SCHEMA)
    path = bucketed.load(docs, root, "numero", "nome", 4)
    spark.sql(f"DROP TABLE {bucketed._table(path)}")
    assert bucketed.read(spark, root).count() == 2
    assert "Bucketed: true" in bucketed._stored(spark, root).groupBy("_id").count()._jdf.queryExecution().executedPlan().toString()


def test_refused(spark):
    root = scratch_path(spark, f"bucketed-{random.random()}")
    docs = spark.createDataFrame([(1, "x", 1, ["p"])], SCHEMA)
    with pytest.raises(ValueError):
        bucketed.load(docs.withColumn("_id", F.lit(1)), root, "numero", "nome", 4)
    bucketed.load(docs, root, "numero", "nome", 4)
    with pytest.raises(ValueError):
        bucketed.load(docs, root, "numero", "nome", 8)

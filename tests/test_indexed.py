"""Range-clustered versions and postings: what is pushed, what is skipped, and
the same rows as a scan with a lambda gives."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import lookup
from tessera.session import scratch_path
from tessera.sources import indexed, snapshot

SCHEMA = "numero long, nome string, tipos array<string>, evolucao struct<condicao: struct<level: long>>"
TOKENS = ["Water", "ÁGUA", "água", "fire", "", None, "waters"]


def _docs(spark, rng, n):
    rows = [(rng.choice([None, i, 7]), rng.choice("xy"), rng.choice([None, [], [rng.choice(TOKENS) for _ in range(rng.randrange(4))]]),
             rng.choice([None, {"condicao": None}, {"condicao": {"level": rng.randrange(25, 110)}}])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def _formatted(spark, df):
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("seed, n", [(1, 0), (2, 1), (3, 400)])
def test_same_rows_as_the_scan(spark, seed, n):
    rng = random.Random(seed)
    root = scratch_path(spark, f"indexed-{rng.random()}-{n}")
    docs = _docs(spark, rng, n)
    docs = docs.unionByName(docs.limit(5))                                         # repeated rows
    indexed.write(docs, root, ["evolucao.condicao.level", "numero"], ["tipos"])
    level = "evolucao.condicao.level"
    want = lookup.water_after_level(docs, 30, 100).collect()
    found = indexed.with_any(spark, root, "tipos", ["water", "Água"], lookup.in_range(level, 30, 100))
    got = lookup.find_sorted(found, F.lit(True), {"numero": "numero", "nome": "nome", "level": level}, "numero", ["nome"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want))
    assert [r[0] for r in got.collect()] == [r[0] for r in want]                   # sorted, NULLs first
    for k in (1, 2, 3):
        assert indexed.count_at_least(spark, root, "tipos", k).first() == lookup.multi_type_count(docs, "tipos", k).first()
    assert indexed.with_any(spark, root, "tipos", []).count() == 0
    assert sorted(map(repr, indexed.read(spark, root).collect())) == sorted(map(repr, docs.collect()))


def _row_groups(path, column, low, high):
    """(row groups whose range of ``column`` meets low..high, all row groups)"""
    hit = every = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).path for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            every += 1
            hit += s is not None and s.has_min_max and s.max >= low and s.min <= high
    return hit, every


def test_filters_reach_the_scans_and_skip_row_groups(spark):
    n = 60_000
    root = scratch_path(spark, f"indexed-{random.random()}")
    docs = spark.range(n).selectExpr(                      # "ring" in a third of the documents, level 5 in a third
        "id AS numero", "array(IF(id % 3 = 0, 'Ring', concat('t', id % 50)), 'x') AS tipos",
        "named_struct('condicao', named_struct('level', IF(id % 3 = 1, 5, id % 200))) AS evolucao")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small files would be merged into one
    try:
        path = indexed.write(docs, root, ["evolucao.condicao.level", "numero"], ["tipos"])
        sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(sizes) < 2 * n / 24                         # the frequent level is split by number
    hit, every = _row_groups(path, "evolucao.condicao.level", 31, 40)
    assert every >= 20 and hit <= 3
    hit, every = _row_groups(f"{root}/postings-tipos/version=000001", "token", "t7", "t7")
    assert every >= 20 and hit <= 3
    df = indexed.with_any(spark, root, "tipos", ["RING"], lookup.in_range("evolucao.condicao.level", 30, 40))
    plan = _formatted(spark, df)
    assert "EqualTo(token,ring)" in plan or "In(token, [ring])" in plan
    assert "GreaterThan(evolucao.condicao.level,30)" in plan
    assert df.count() == docs.where(
        "array_contains(tipos, 'Ring') AND evolucao.condicao.level > 30 AND evolucao.condicao.level <= 40").count()
    plan = _formatted(spark, indexed.count_at_least(spark, root, "tipos", 2))
    assert "GreaterThanOrEqual(n,2)" in plan and "EqualTo(place,0)" in plan and "tipos" not in plan.split("ReadSchema")[1]


def test_postings_follow_the_version(spark):
    root = scratch_path(spark, f"indexed-{random.random()}")
    rng = random.Random(5)
    indexed.write(_docs(spark, rng, 30), root, ["numero"], ["tipos"])
    second = _docs(spark, rng, 20)
    indexed.write(second, root, ["numero"], ["tipos"])
    assert indexed.with_any(spark, root, "tipos", ["fire"]).count() == \
        second.where("exists(tipos, t -> lower(t) = 'fire')").count()
    assert snapshot.committed_versions(spark, root) == [1, 2]
    with pytest.raises(ValueError):
        indexed.write(second.withColumn("_doc", F.lit(1)), root, ["numero"], ["tipos"])
    with pytest.raises(ValueError):
        indexed.count_at_least(spark, root, "tipos", 0)

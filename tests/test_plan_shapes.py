"""Plan-shape guards for scale: no cross or nested-loop joins anywhere, no
window over a data key in the chain operators, partial aggregation before
the shuffle for keyed selections, and nested-path filters pushed to Parquet."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import chain, dedup, lookup, merge

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_no_cross_or_nested_loop_join(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_keyed_selections_aggregate_partially(spark):
    df = spark.createDataFrame([(i % 3, i, f"v{i}") for i in range(30)], "k int, seq long, v string")
    assert "partial_min_by" in _plan(dedup.keep_first(df, "k", "seq"))
    assert "partial_min_by" in _plan(dedup.first_match_else_first(df, "k", F.col("v") == "v4", "seq", ["v"]))
    upd = df.withColumn("name", F.lit("n"))
    assert "partial_max_by" in _plan(merge.fold_updates(upd, "k", "seq", ["v", "name"]))


def test_chain_operators_use_no_window(spark):
    df = spark.createDataFrame([(1, i, f"r{i}") for i in range(6)], "c int, p int, r string")
    assert "Window" not in _plan(chain.pair_with_next(df, "c", "p", ["r"]))
    assert "Window" not in _plan(chain.successors_after_first_match(df, "c", "p", F.col("r") == "r2"))


def test_nested_level_filter_reaches_parquet(spark):
    from tessera.plans import catalogue
    path = tempfile.mkdtemp(prefix="tessera-docs-") + "/docs"
    catalogue.part_documents(spark, SF).write.parquet(path)
    df = lookup.water_after_level(spark.read.parquet(path), 30, 100)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThan(evolucao.condicao.level,30)" in plan
    assert "LessThanOrEqual(evolucao.condicao.level,100)" in plan
    # only the referenced leaf of the nested struct is read
    assert "evolucao:struct<condicao:struct<level:int>>" in plan


def test_merge_reads_its_base_at_most_twice(spark):
    path = tempfile.mkdtemp(prefix="tessera-base-") + "/base"
    spark.range(1000).selectExpr("id AS key", "concat('n', id % 7) AS name", "id AS v").write.parquet(path)
    upd = spark.range(100).selectExpr("IF(id % 2 = 0, id, NULL) AS key", "concat('n', id % 9) AS name", "id AS v", "id AS seq")
    df = merge.upsert(spark.read.parquet(path), upd, "key", "name", "seq")
    assert _plan(df).count("FileScan parquet") <= 2


def test_building_a_lookup_runs_no_job(spark):
    from __spark_entry__ import queries
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for name in ("link_extract", "page_title_clean", "upsert_patch", "dedup_keep_first"):
            queries()[name](spark, SF)
        # reading a Parquet footer for the schema is the only job there is
        assert len(tracker.getJobIdsForGroup("build")) <= 10
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_dedup_shuffles_no_text(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["dedup_keep_first"](spark, SF))
    exchange = plan[:plan.index("Exchange")]
    assert "text#" not in exchange and "sha2" in plan

"""Session helpers: the shared scratch folder, written intermediates, spreading."""

from tessera import session


def test_checkpoint_folder_is_read_from_configuration(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = session.ensure_checkpoint_dir(spark)
    assert configured is None or path == configured
    assert session.scratch_path(spark, "x").startswith(path.rstrip("/") + "/")


def test_materialize_writes_under_the_checkpoint_folder(spark):
    df = session.materialize(spark.range(10).toDF("v"), "unit")
    files = df.inputFiles()
    assert files and all(session.ensure_checkpoint_dir(spark).rstrip("/") in f for f in files)
    assert sorted(r.v for r in df.collect()) == list(range(10))


def test_only_a_scan_of_one_split_is_dealt_out(spark):
    from tessera.plans.tables import table
    sf = "/root/testdata/sf0.001"
    assert table(spark, sf, "pages").rdd.getNumPartitions() == 1
    assert table(spark, sf, "pages", cpu_heavy=True).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_one_row_group_in_many_splits_is_dealt_out(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.plans import tables
    spark.range(50_000).selectExpr("id AS p_partkey", "sha2(string(id), 256) AS p_name").coalesce(1) \
        .write.parquet(f"{tmp_path}/part.parquet")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        scan = tables.table(spark, str(tmp_path), "part")
        dealt = tables.table(spark, str(tmp_path), "part", cpu_heavy=True)
        splits = scan.rdd.getNumPartitions()
        counts = [[r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()] for df in (scan, dealt)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert splits > 4 and max(counts[0]) == 50_000          # many splits, one has the rows
    assert sum(counts[1]) == 50_000 and max(counts[1]) <= tables.ROWS_PER_TASK
    assert sorted(r.p_partkey for r in dealt.select("p_partkey").collect()) == list(range(50_000))

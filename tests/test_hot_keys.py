"""Hot keys: a third of the rows on one key / one chain (generated rows)."""

from pyspark.sql import functions as F

from tessera.operators import chain, dedup, merge

N = 300_000


def _hot(spark):
    # key 0 holds every third row; the rest are spread over N // 10 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % (N // 10) + 1).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 7).cast("string").alias("v"))


def test_keyed_selections_on_a_hot_key(spark):
    df = _hot(spark)
    firsts = dedup.keep_first(df, "k", "seq")
    assert firsts.count() == df.select("k").distinct().count()
    assert firsts.where("k = 0").first()["seq"] == 0
    fm = dedup.first_match_else_first(df, "k", F.col("v") == "5", "seq", ["seq"])
    assert fm.where("k = 0").first()["seq"] == 12        # first multiple of 3 with id % 7 == 5
    folded = merge.fold_updates(df.withColumn("w", F.when(F.col("seq") < 10, F.col("v"))), "k", "seq", ["w"])
    assert folded.where("k = 0").first()["w"] == "2"     # last non-NULL w of key 0 is at seq 9


def test_chain_walks_on_a_hot_chain(spark):
    rows = spark.range(N).select((F.col("id") % 3 != 0).cast("int").alias("c"),   # chain 0: a third of rows
                                 (F.col("id") / 3).cast("long").alias("p0"), F.col("id"))
    # dense positions per chain: chain 0 gets 0..N/3-1, chain 1 the rest
    df = rows.select("c", F.when(F.col("c") == 0, F.col("p0"))
                     .otherwise(F.col("id") - F.col("p0") - 1).alias("p"),
                     F.when(F.col("id") == 30, F.lit("hit")).otherwise(F.lit("x")).alias("r"))
    pairs = chain.pair_with_next(df, "c", "p", ["r"])
    assert pairs.where("c = 0").count() == (N // 3 + 1) // 2
    succ = chain.successors_after_first_match(df, "c", "p", F.col("r") == "hit")
    assert succ.count() == N // 3 - 10 - 1               # id 30 is position 10 of chain 0


def test_hot_chain_is_split(spark):
    """Without broadcasts, a third of the rows on one chain: the final plan of
    the walk splits that chain's partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = _hot(spark).select(F.col("k").alias("c"), F.col("seq").alias("p"), F.col("v").alias("r"))
        df = df.unionByName(df.where("false")).repartition(8)
        out = chain.successors_after_first_match(df, "c", "p", F.col("r") == "2")
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

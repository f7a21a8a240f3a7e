"""Access to the driver tables (one Parquet file per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


ROWS_PER_TASK = 20_000         # rows of expensive work that one task takes


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
          cpu_heavy: bool = False) -> DataFrame:
    """Scan one table (optionally only ``columns``). ``cpu_heavy`` deals a scan
    to tasks of at most about ``ROWS_PER_TASK`` rows, as many as there are cores
    or more, before expensive per-row work, unless its splits are about as even
    already. A row group is read by one split whole, so a small file of many
    rows is one task however many splits it has."""
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if cpu_heavy else df


def spread(scan: DataFrame) -> DataFrame:
    """The rows of a Parquet scan in even tasks. Their counts by split come from
    the files' footers; no column is read for them."""
    counts = [r["count"] for r in scan.select().groupBy(F.spark_partition_id()).count().collect()]
    tasks = max(scan.sparkSession.sparkContext.defaultParallelism, -(-sum(counts) // ROWS_PER_TASK))
    if max(counts, default=0) > 2 * -(-sum(counts) // tasks):
        scan = scan.repartition(tasks)
    return scan

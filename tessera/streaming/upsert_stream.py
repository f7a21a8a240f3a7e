"""Incremental load: the patch-upsert (J3) applied to each micro-batch of a
stream of partial documents, into a versioned snapshot (K2).

Exactly-once comes from two pieces: the stream's own checkpoint (offsets) and
the snapshot's commit marker, which records the last batch id of every stream
by the stream's id -- a batch replayed after a failure finds its id applied and
is skipped, while a stream with a new checkpoint folder, whose batches start at
0 again, has a new id and is applied. Each batch writes a complete new version,
so a reader never sees a half-applied batch; the write counters (G6) of a
version are written before its marker, under the version's number.

Each batch reads the whole current version (the name match of key-less
updates can target any document) and writes a new one; size the trigger so
batches are large relative to that cost.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..sources import snapshot

COUNTERS = "_counters"


def apply_batch(batch: DataFrame, epoch: int, root: str, schema: T.StructType,
                key: str, name: str, seq: str, stream: str) -> None:
    """Merge one batch of the stream with the id ``stream``."""
    if not stream:
        raise ValueError("a batch needs the id of its stream")
    spark = batch.sparkSession
    done = snapshot.last_epoch(spark, root, stream)
    if done is not None and epoch <= done:
        return
    base = (snapshot.read_snapshot(spark, root) if snapshot.current_version(spark, root) is not None
            else spark.createDataFrame([], schema))
    merged = merge.upsert(base.select(*schema.fieldNames()), batch, key, name, seq)

    def count(path: str, version: int) -> None:
        # The version keeps the ``op`` of this write; counters come from a
        # column-pruned read of it, so the merge runs once per batch.
        merge.write_counters(spark.read.parquet(path).select(merge.OP)) \
            .withColumn("stream", F.lit(stream)).withColumn("epoch", F.lit(epoch)) \
            .withColumn("version_path", F.lit(path)) \
            .write.mode("overwrite").parquet(f"{root}/{COUNTERS}/version={version:06d}")

    snapshot.write_snapshot(merged, root, stream, epoch, count)


def counters(spark: SparkSession, root: str) -> DataFrame:
    """G6 of every committed version that a stream wrote."""
    done = snapshot.committed_versions(spark, root)
    return spark.read.parquet(f"{root}/{COUNTERS}").where(F.col("version").isin(done))


def _stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id that a stream keeps in its checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()[0])["id"]


def start_upsert_stream(updates: DataFrame, root: str, schema: T.StructType, key: str, name: str,
                        seq: str, checkpoint_location: str, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """Run J3 per micro-batch of a streaming DataFrame of partial documents
    (the columns of ``schema`` plus ``seq``)."""
    writer = (updates.writeStream
              .option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda df, epoch: apply_batch(
                  df, epoch, root, schema, key, name, seq, _stream_id(df.sparkSession, checkpoint_location))))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

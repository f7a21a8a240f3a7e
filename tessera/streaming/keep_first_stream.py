"""Keep-first dedup (G3) over a stream, across its micro-batches.

``dedup.keep_first`` is an aggregate with a partial step, so on a stream its
state -- the least row of every key so far -- lives in the state store, by key,
and a frequent key is reduced before each shuffle. In update mode a batch hands
on only the keys whose row it set or replaced; they are written as the batch's
own folder, which a replay overwrites with the same rows. Batches may come in
any order: where a row with a lesser ``order`` comes later, it replaces the one
kept, so the rows read are those of one ``keep_first`` over all input, however
it was split.

State grows with the number of distinct keys (one row each), as keeping the
first of all time needs; its folder, the checkpoint, must be shared storage.
Reading folds the changes, at most one row per key and batch.

Defined cases: NULL keys are one group, as in ``dedup``; a repeated row changes
nothing; of rows that share key and order one is kept (``order`` should be
unique); before the first batch there is nothing to read, and an empty frame
comes back.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup


def start_keep_first(rows: DataFrame, out: str, key, order, checkpoint_location: str, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Keep the row of least ``order`` per ``key`` of a streaming DataFrame;
    ``read_kept`` gives the rows kept so far from ``out``."""
    def changed(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    writer = (dedup.keep_first(rows, key, order).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint_location).foreachBatch(changed))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_kept(spark: SparkSession, out: str, schema: T.StructType, key, order) -> DataFrame:
    """The rows kept so far. Who reads while a batch is replayed after a failure
    may miss that batch's changes until it is written again."""
    try:
        changes = spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return dedup.keep_first(changes.select(*schema.fieldNames()), key, order)

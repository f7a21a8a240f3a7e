"""Incremental upsert stream: micro-batches merged into a versioned snapshot,
replays skipped."""

import os
import tempfile

from pyspark.sql import types as T

from tessera.sources import snapshot
from tessera.streaming import upsert_stream

SCHEMA = T.StructType([T.StructField("numero", T.LongType()), T.StructField("nome", T.StringType()),
                       T.StructField("peso", T.DoubleType())])
UPD = "numero long, nome string, peso double, seq long"


def test_stream_upsert_and_replay(spark):
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    src, root, ckpt = os.path.join(d, "in"), os.path.join(d, "snap"), os.path.join(d, "ckpt")
    spark.createDataFrame([(1, "A", 1.0, 0), (2, "B", 2.0, 1)], UPD).write.parquet(f"{src}/b0")
    stream = spark.readStream.schema(UPD).parquet(f"{src}/*")
    q = upsert_stream.start_upsert_stream(stream, root, SCHEMA, "numero", "nome", "seq", ckpt)
    q.awaitTermination()
    spark.createDataFrame([(1, None, 5.0, 2), (None, "B", 7.0, 3), (3, "C", None, 4)], UPD) \
        .write.parquet(f"{src}/b1")
    q = upsert_stream.start_upsert_stream(spark.readStream.schema(UPD).parquet(f"{src}/*"),
                                          root, SCHEMA, "numero", "nome", "seq", ckpt)
    q.awaitTermination()
    snap = {r["numero"]: (r["nome"], r["peso"]) for r in snapshot.read_snapshot(spark, root).collect()}
    assert snap == {1: ("A", 5.0), 2: ("B", 7.0), 3: ("C", None)}
    counters = sorted(tuple(r) for r in upsert_stream.counters(spark, root)
                      .select("epoch", "inserted", "modified").collect())
    assert counters == [(0, 2, 0), (1, 1, 2)]
    # replaying an applied batch id changes nothing, also after a batch load
    stream_id = upsert_stream._stream_id(spark, ckpt)
    snapshot.write_snapshot(snapshot.read_snapshot(spark, root), root)
    before = snapshot.current_version(spark, root)
    z = spark.createDataFrame([(9, "Z", 1.0, 9)], UPD)
    upsert_stream.apply_batch(z, 1, root, SCHEMA, "numero", "nome", "seq", stream_id)
    assert snapshot.current_version(spark, root) == before
    # a stream with a new checkpoint folder starts at batch 0 and is applied
    z.write.parquet(f"{src}2/b0")
    q = upsert_stream.start_upsert_stream(spark.readStream.schema(UPD).parquet(f"{src}2/*"),
                                          root, SCHEMA, "numero", "nome", "seq", f"{ckpt}2")
    q.awaitTermination()
    assert snapshot.read_snapshot(spark, root).where("numero = 9").count() == 1
    assert snapshot.stream_epochs(spark, root)[stream_id] == 1

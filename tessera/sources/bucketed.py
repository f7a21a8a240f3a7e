"""A collection bucketed by its documents' identity.

``merge.upsert`` shuffles the whole collection with every batch. Here a version
is a bucketed table (Spark's own ``bucketBy`` on ``_id``), so the merge joins
the batch to it bucket by bucket: only the batch is shuffled, and the task that
merges a bucket writes that bucket of the next version.

A stored document has two columns more than the collection: ``_id``, its
identity for good, and ``_salt``, a hash of its content if it has no key (it
orders the documents without a key among those of a name, as in ``merge``).
``_id`` is made from the key and a number among documents of that key, or from
the content hash and such a number, or, for a document that a batch inserts by
name, from the batch's version and the name; so documents without a key spread
over the buckets like all others.

The number of buckets is fixed when a collection is first loaded and kept in its
folder. A version is read through an external table over its files, which is
entered into the session's catalog when it is not there; dropping it loses
nothing.

Defined cases: as in ``merge`` (NULL names are a name, several updates fold,
repeated keys have one patched copy, which stays the same one for later
batches); an empty base or batch gives the other
one; columns called ``_id``, ``_salt`` or ``op`` can't be stored and raise.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from . import snapshot

ID, SALT = "_id", "_salt"
_SETTINGS = "bucketing"


def _table(path: str) -> str:
    return "tessera_" + hashlib.md5(path.encode()).hexdigest()


def _bucketed_writer(buckets: int):
    def write(df: DataFrame, path: str) -> None:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {_table(path)}")
        (df.write.mode("overwrite").format("parquet").option("path", path)
         .bucketBy(buckets, ID).sortBy(ID).saveAsTable(_table(path)))
    return write


def _stored(spark: SparkSession, root: str) -> DataFrame:
    """The current version with ``_id`` and ``_salt``, as a bucketed scan."""
    version = snapshot.current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    path = snapshot.version_path(root, version)
    if not spark.catalog.tableExists(_table(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {_table(path)} ({columns}) USING parquet "
                  f"CLUSTERED BY ({ID}) SORTED BY ({ID}) INTO {settings(spark, root)['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(_table(path))


def settings(spark: SparkSession, root: str) -> dict:
    """key, name and number of buckets of the collection."""
    return json.loads(spark.read.text(f"{root}/{_SETTINGS}").first()[0])


def _content_hash(columns: list[str], key: str):
    content = F.to_json(F.struct(*[F.col(c) for c in columns]))
    return F.when(F.col(key).isNull(), F.xxhash64(content)).otherwise(F.lit(0).cast("bigint"))


def load(docs: DataFrame, root: str, key: str, name: str, buckets: int = 200) -> str:
    """K3: ``docs`` as the first or next version, whatever was there. Choose
    ``buckets`` so that one of them fits a task's memory (collection size / 128 MB)."""
    if clash := {ID, SALT, merge.OP} & set(docs.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    spark = docs.sparkSession
    kept = json.dumps({"key": key, "name": name, "buckets": buckets})
    if snapshot.current_version(spark, root) is None:
        spark.createDataFrame([(kept,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{_SETTINGS}")
    elif settings(spark, root) != json.loads(kept):
        raise ValueError("key, name and number of buckets of a collection don't change")
    numbered = merge._identified(docs, key)
    ident = F.concat(F.col("_dup").cast("string"), F.when(F.col(key).isNull(), F.concat(F.lit("c"), F.col(SALT)))
                     .otherwise(F.concat(F.lit("k"), F.col(key).cast("string"))))
    rows = numbered.select(*docs.columns, F.lit("insert").alias(merge.OP), SALT, ident.alias(ID))
    return snapshot.write_snapshot(rows, root, write=_bucketed_writer(buckets))


def read(spark: SparkSession, root: str) -> DataFrame:
    """The documents of the current version, with the ``op`` of its load."""
    return _stored(spark, root).drop(ID, SALT)


def merged(base: DataFrame, updates: DataFrame, key: str, name: str, seq: str, batch: str) -> DataFrame:
    """J3 of ``updates`` into a stored version. ``base`` is scanned twice, in
    buckets both times: key and name for the choice of targets, then whole; it
    meets the folded batch in one join. ``batch`` tells this merge from others."""
    cols = [c for c in base.columns if c not in (ID, SALT, merge.OP)]
    types = {f.name: f.dataType for f in base.schema.fields}
    fields = [c for c in cols if c != key]
    rest = [f for f in fields if f != name]
    upd = updates.select(*cols, seq)

    keyed = (merge.fold_updates(upd.where(F.col(key).isNotNull()), key, seq, fields).drop(seq)
             .withColumn(ID, F.concat(F.lit("1k"), F.col(key).cast("string"))))
    named = merge.fold_updates(upd.where(F.col(key).isNull()), name, seq, rest).drop(seq)

    # The document that each name's update goes to, among names as phase 1 leaves them.
    b, u = base.select(ID, key, name, SALT).alias("b"), keyed.select(ID, key, name).alias("u")
    after = b.join(u, F.col(f"b.{ID}") == F.col(f"u.{ID}"), "full_outer").select(
        F.coalesce(f"u.{name}", f"b.{name}").alias("_tn"), F.coalesce(f"b.{key}", f"u.{key}").alias("_k"),
        F.coalesce(f"b.{SALT}", F.lit(0).cast("bigint")).alias(SALT), F.coalesce(f"b.{ID}", f"u.{ID}").alias(ID))
    targets = after.groupBy("_tn").agg(F.min(F.struct(F.col("_k").isNull().alias("_null"), "_k", SALT, ID)).alias("_t"))
    fresh = F.concat(F.lit(f"1n{batch}"), F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("-")))
    named = (named.join(targets, F.col(name).eqNullSafe(F.col("_tn")), "left")
             .withColumn(ID, F.coalesce("_t._id", fresh)).drop("_tn", "_t"))

    # What the batch does to a document: the keyed update, then the named one.
    u, k = keyed.alias("u"), named.alias("k")
    both = u.join(k, F.col(f"u.{ID}") == F.col(f"k.{ID}"), "full_outer").select(
        F.coalesce(f"u.{ID}", f"k.{ID}").alias(ID),
        F.when(F.col(f"u.{ID}").isNotNull(), F.struct(*[F.col(f"u.{c}") for c in cols])).alias("u"),
        F.when(F.col(f"k.{ID}").isNotNull(), F.struct(*[F.col(f"k.{c}") for c in [name, *rest]])).alias("k")).alias("p")
    joined = base.alias("b").join(both, F.col(f"b.{ID}") == F.col(f"p.{ID}"), "full_outer")

    def differs(new, old, f):
        return ~merge._comparable(new, types[f]).eqNullSafe(merge._comparable(old, types[f]))

    col = F.col
    first = {f: F.coalesce(col(f"p.u.{f}"), col(f"b.{f}")) for f in fields}
    second = {f: F.coalesce(col(f"p.k.{f}"), first[f]) for f in rest}
    in_b, by_key, by_name = col(f"b.{ID}").isNotNull(), col("p.u").isNotNull(), col("p.k").isNotNull()
    changed = F.lit(False)
    for f in fields:
        changed = changed | (by_key & differs(first[f], col(f"b.{f}"), f))
    for f in rest:
        changed = changed | (by_name & differs(second[f], first[f], f))
    op = (F.when(~in_b, F.lit("insert")).when(~by_key & ~by_name, F.lit("keep"))
          .when(changed, F.lit("modify")).otherwise(F.lit("same")))
    new_name = F.when(in_b | by_key, first[name]).otherwise(col(f"p.k.{name}"))
    out = {key: F.coalesce(col(f"b.{key}"), col(f"p.u.{key}")), name: new_name, **second}
    done = joined.select(*[out[c].alias(c) for c in cols], op.alias(merge.OP), F.coalesce(f"b.{ID}", f"p.{ID}").alias(ID))
    return done.select(*cols, merge.OP, _content_hash(cols, key).alias(SALT), ID)


def upsert(spark: SparkSession, root: str, updates: DataFrame, seq: str, stream: str | None = None,
           epoch: int | None = None) -> str:
    """J3 + K2: merge a batch into the current version and commit the next one
    (``stream`` and ``epoch`` as in ``snapshot.write_snapshot``)."""
    kept = settings(spark, root)
    batch = f"{(snapshot.current_version(spark, root) or 0) + 1}"
    out = merged(_stored(spark, root), updates, kept["key"], kept["name"], seq, batch)
    return snapshot.write_snapshot(out, root, stream, epoch, write=_bucketed_writer(kept["buckets"]))

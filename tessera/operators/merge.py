"""Patch-upsert of a batch of partial documents into a snapshot.

Semantics (a keyed "$set" with upsert):

* an update whose primary key is set targets the document with that key (of
  several, one, chosen by content);
* an update without primary key targets, by null-safe equality on the
  secondary key (a name), the document with the least primary key among
  those with that name (NULL primary key last, those by content); at most one
  target, also among documents that are equal in every field;
* a matched document takes every field the update sets (non-NULL) and keeps
  the others -- an empty list or map *is* a value and replaces; a NULL is
  "not present" and does not;
* an unmatched update is inserted;
* several updates for the same target inside one batch are folded first: per
  field, the value of the latest update (by ``seq``) that sets it.

Plan shape: fold = one aggregation per key space with map-side partial
``max_by`` (a hot key is reduced before the shuffle). A document is known by
its key, or without one by a hash of its content and a number among equal
documents; the number comes from a window over that identity, whose shuffle is
the one that phase 1 needs. Phase 1 = full outer equi-join on the identity, so
documents without a key never meet in one partition. Phase 2 = the target of a
name is chosen by an aggregate over the names (one row per name); one full
outer join on the target's identity patches it and appends the updates without
a target. The base is read twice: for the result and for the choice of targets.

``op`` tags each output row: ``insert`` / ``modify`` (matched and changed) /
``same`` (matched, nothing changed) / ``keep`` (not touched by the batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OP = "op"


def _comparable(c, dtype: T.DataType):
    """A value that supports null-safe equality (maps are not comparable)."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def fold_updates(updates: DataFrame, key, seq: str, fields: list[str]) -> DataFrame:
    """Per key, each field takes its last non-NULL value by ``seq``."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(seq))).alias(f) for f in fields]
    return updates.groupBy(*keys).agg(*aggs, F.max(seq).alias(seq))


def _patch(base_alias: str, upd_alias: str, fields: list[str]):
    return [F.coalesce(F.col(f"{upd_alias}.{f}"), F.col(f"{base_alias}.{f}")).alias(f) for f in fields]


def _changed(base_alias: str, upd_alias: str, fields: list[str], types: dict):
    diffs = [~_comparable(F.coalesce(F.col(f"{upd_alias}.{f}"), F.col(f"{base_alias}.{f}")), types[f])
             .eqNullSafe(_comparable(F.col(f"{base_alias}.{f}"), types[f])) for f in fields]
    out = F.lit(False)
    for d in diffs:
        out = out | d
    return out


def _identified(base: DataFrame, key: str) -> DataFrame:
    """``base`` with ``_salt`` (0 for keyed documents, else a hash of the
    content) and ``_dup`` (1, 2, ... among documents of one identity, by
    content: both readings of the base number copies of a key alike)."""
    content = F.to_json(F.struct(*[F.col(c) for c in base.columns]))
    hashed = base.withColumn("_hash", F.xxhash64(content))
    salted = hashed.withColumn("_salt", F.when(F.col(key).isNull(), F.col("_hash")).otherwise(F.lit(0).cast("bigint")))
    same = Window.partitionBy(key, "_salt").orderBy("_hash")
    return salted.withColumn("_dup", F.row_number().over(same)).drop("_hash")


def upsert(base: DataFrame, updates: DataFrame, key: str, name: str, seq: str) -> DataFrame:
    """Merge ``updates`` into ``base``; returns the new snapshot with an
    ``op`` column. ``updates`` has the columns of ``base`` plus ``seq``."""
    cols = [c for c in base.columns if c != OP]
    types = {f.name: f.dataType for f in base.schema.fields}
    fields = [c for c in cols if c != key]
    upd = updates.select(*cols, seq)

    # Phase 1: primary key.
    b = _identified(base.select(*cols), key).alias("b")
    u = (fold_updates(upd.where(F.col(key).isNotNull()), key, seq, fields).drop(seq)
         .withColumn("_salt", F.lit(0).cast("bigint")).alias("u"))
    # Of copies of a key the first is patched, a condition beside the join's
    # keys, so the window's partitioning serves the join too.
    j1 = b.join(u, (F.col(f"b.{key}") == F.col(f"u.{key}")) & (F.col("b._salt") == F.col("u._salt"))
                & (F.col("b._dup") == 1), "full_outer")
    in_b, u_hit = F.col("b._dup").isNotNull(), F.col(f"u.{key}").isNotNull()
    op1 = (F.when(~in_b, F.lit("insert"))
           .when(~u_hit, F.lit("keep"))
           .when(_changed("b", "u", fields, types), F.lit("modify"))
           .otherwise(F.lit("same")))
    phase1 = j1.select(F.coalesce(F.col(f"u.{key}"), F.col(f"b.{key}")).alias(key),
                       *_patch("b", "u", fields), op1.alias(OP),
                       F.coalesce("b._salt", "u._salt").alias("_salt"), F.coalesce("b._dup", F.lit(1)).alias("_dup"))

    # Phase 2: secondary key (null-safe) for updates without a primary key.
    rest = [f for f in fields if f != name]
    keyless = fold_updates(upd.where(F.col(key).isNull()), name, seq, rest).drop(seq)
    identity = F.struct(F.col(key).isNull().alias("_null"), F.col(key).alias("_k"), "_salt", "_dup")
    targets = phase1.groupBy(F.col(name).alias("_tn")).agg(F.min(identity).alias("_t"))
    # An update without a target gets an identity that no document has, and
    # one that spreads: it comes out of the outer join unmatched.
    k = (keyless.join(targets, keyless[name].eqNullSafe(F.col("_tn")), "left")
         .select(*[F.col(c) for c in keyless.columns], F.col("_t._k").alias("_tk"),
                 F.coalesce("_t._salt", F.xxhash64(name)).alias("_ts"), F.coalesce("_t._dup", F.lit(0)).alias("_td"))
         .alias("k"))
    p = phase1.alias("p")
    cond = ((F.col("p._salt") == F.col("k._ts")) & (F.col("p._dup") == F.col("k._td"))
            & F.col(f"p.{key}").eqNullSafe(F.col("k._tk")))
    j2 = p.join(k, cond, "full_outer")
    in_p, k_hit = F.col("p._dup").isNotNull(), F.col("k._td").isNotNull()
    op2 = (F.when(~in_p, F.lit("insert"))
           .when(~k_hit | (F.col(f"p.{OP}") == "insert"), F.col(f"p.{OP}"))
           .when(_changed("p", "k", rest, types), F.lit("modify"))
           .when(F.col(f"p.{OP}") == "keep", F.lit("same"))
           .otherwise(F.col(f"p.{OP}")))
    out = j2.select(F.col(f"p.{key}").alias(key), F.when(in_p, F.col(f"p.{name}")).otherwise(F.col(f"k.{name}")).alias(name),
                    *_patch("p", "k", rest), op2.alias(OP))
    return out.select(*cols, OP)


def write_counters(merged: DataFrame) -> DataFrame:
    """One row of counters over a merge result."""
    op = F.col(OP)
    return merged.agg(
        F.count_if(op == "insert").cast("bigint").alias("inserted"),
        F.count_if(op == "modify").cast("bigint").alias("modified"),
        F.count_if(op == "same").cast("bigint").alias("unchanged"),
        F.count_if(op == "keep").cast("bigint").alias("untouched"))

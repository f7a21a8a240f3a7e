"""Mixing sources to target weights by a low-discrepancy schedule. Native
DataFrame functions only.

1. Targets: sources in code-point order (NULL last) weigh 5, 2, 1, repeating,
   and share ``share`` x all words; a target stops at ``cap`` x its source and
   the excess is shared again by weight (water filling, closed form over the
   table of sources).
2. Streams: the documents of a source in hash order form one stream of words,
   cut into blocks of ``block`` words. Positions come from two levels of sums
   (bucket within source, document within bucket), so no window ever holds a
   whole source.
3. Schedule: golden-ratio points mapped through the cumulative slot counts
   give each slot a source; the rank of a slot within its source (again two
   levels) names the block it takes. A source whose points fall short gets the
   missing ranks after the last slot, and points beyond its need are left
   out, so each source takes floor(target) words exactly.
4. Slots join blocks on (source, block); a document takes the sum of its words
   in the slots' blocks: whole copies, and for the one document in which a
   target ends, a prefix.

Only the table of sources (one row each) passes through one task. The order is
a function of row content, so reruns agree.

Defined cases: NULL text has 0 words; rows without words take 0; NULL source is
a source of its own; fully repeated rows are separate documents; an empty
table gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialize, packed, row_keys, rows_and, text_of, unpacked

WEIGHTS = (5, 2, 1)
_PERIOD = 1 << 31                    # points are multiples of 2^-31
_GOLDEN = 1327217885                 # 2^31 / golden ratio, rounded to odd
_CHUNK = 1 << 12                     # slots ranked together
_DOCS_PER_BUCKET = 2000


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _numbered(docs: DataFrame) -> list[Column]:
    """Key columns of a row; ``dup`` numbers fully repeated rows."""
    return [*row_keys("doc_id", "source", "text")]


def _dup() -> Column:
    return F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_k1")).alias("dup")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per source: sid, source, source_size, target (one row per source)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    asc = Window.orderBy(F.col("most") / F.col("w"), "sid")
    before = asc.rowsBetween(Window.unboundedPreceding, -1)
    after = asc.rowsBetween(0, Window.unboundedFollowing)
    all_of = Window.partitionBy()
    level = ((F.lit(float(share)) * F.sum("source_size").over(all_of)
              - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # The level rises while sources are capped and falls after: the highest is the shared one.
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(all_of))
    return per.select("sid", "source", "source_size",
                      F.least("most", F.col("w") * F.col("level")).alias("target"))


def plan_slots(targets: DataFrame, block: int) -> DataFrame:
    """Per source: blocks of one pass, whole passes, words of the last pass and
    the number of slots, with the first slot number in cumulative order."""
    words = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    t = (targets.withColumn("passes", passes)
         .withColumn("rest", words - F.col("passes") * F.col("source_size"))
         .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
         .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long")))
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumn("lo", F.coalesce(F.sum("slots").over(before), F.lit(0)).cast("long"))


def schedule(plan: DataFrame, n_slots: int, block: int) -> DataFrame:
    """One row per slot: slot, sid, block, words (taken from the block's start)."""
    spark = plan.sparkSession
    grain = max(1, -(-n_slots // 4096))          # range join through at most ~4096 + sources cells
    cells = (plan.where("slots > 0")
             .withColumn("hi", F.col("lo") + F.col("slots"))
             .select("sid", "lo", "hi", F.explode(F.sequence(
                 F.floor(F.col("lo") / grain), F.floor((F.col("hi") - 1) / grain))).alias("cell")))
    point = (F.col("slot") % _PERIOD * _GOLDEN + _PERIOD // 2) % _PERIOD
    at = F.floor(point * F.lit(float(n_slots)) / F.lit(float(_PERIOD))).cast("long")
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("at", at)
    slots = (slots.withColumn("cell", F.floor(F.col("at") / grain)).join(cells, "cell")
             .where("at >= lo and at < hi")
             .select("slot", "sid", F.floor(F.col("slot") / _CHUNK).alias("chunk")))
    counts = slots.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = (slots.withColumn("r", inside).join(starts, ["sid", "chunk"])
              .select("slot", "sid", (F.col("first") + F.col("r")).alias("rank")))
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    short = (plan.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
             .where("slots > got")
             .select("sid", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank"))
             .select((F.lit(n_slots) + F.col("rank")).alias("slot"), "sid", "rank"))
    every = ranked.unionByName(short).join(plan, "sid").where("rank < slots")
    number = F.col("rank") % F.col("blocks")
    last = F.col("rank") >= F.col("passes") * F.col("blocks")
    end = F.when(last, F.col("rest")).otherwise(F.col("source_size"))
    return every.select("slot", "sid", number.alias("block"),
                        F.least(F.lit(block), end - number * block).alias("words"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, block: int = 256):
    """(rows, slots): per input row its keys, doc_id, size, source_size, target
    and taken words; and the schedule."""
    sizes = docs.select(*_numbered(docs), "doc_id", "source", n_words(text_of("text")).alias("size"))
    sizes = materialize(sizes.withColumn("dup", _dup()), "mix-sizes")
    plan = materialize(plan_slots(source_targets(sizes, weights, share, cap), block), "mix-plan")
    total = rows_and(sizes)["n"]
    n_slots = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    named = sizes.join(plan.select("sid", "source", "source_size", "target"),
                       sizes["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    order = F.xxhash64(F.lit("mix"), "_k1", "_k2", "dup")
    spread = max(1, -(-total // _DOCS_PER_BUCKET))
    named = named.withColumn("h", order).withColumn("bucket", F.pmod("h", F.lit(spread)))
    sums = named.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = (Window.partitionBy("sid", "bucket").orderBy("h", "_k1", "_k2", "dup")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = (named.withColumn("upto", F.sum("size").over(inside)).join(starts, ["sid", "bucket"])
              .withColumn("hi", F.col("first") + F.col("upto")).withColumn("lo", F.col("hi") - F.col("size")))

    slots = schedule(plan, n_slots, block)
    parts = placed.where("size > 0").select("_k1", "_k2", "dup", "sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("block"))
    start = F.col("block") * block
    got = F.least("hi", start + F.col("words")) - F.greatest("lo", start)
    taken = (parts.join(slots, ["sid", "block"]).select("_k1", "_k2", "dup", F.greatest(got, F.lit(0)).alias("got"))
             .groupBy("_k1", "_k2", "dup").agg(F.sum("got").alias("taken")))
    rows = (named.select("_k1", "_k2", "dup", "doc_id", "size", "source_size", "target")
            .join(taken, ["_k1", "_k2", "dup"], "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")))
    return rows, slots


def mix_report(docs: DataFrame, **kw) -> DataFrame:
    rows, _ = mix(docs, **kw)
    return rows.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix as documents: a row for each whole copy taken, and for the one
    document in which a source's target ends a row with its first words, joined
    by single blanks. Same columns; ``n_chars``, where present, follows the text."""
    rows, _ = mix(docs, **kw)
    rows = rows.where("taken > 0").select("_k1", "_k2", "dup", "size", "taken")
    whole = packed(docs, *_numbered(docs)).withColumn("dup", _dup())
    part = F.col("taken") % F.col("size")
    uses = F.concat(F.array_repeat(F.lit(0).cast("long"), F.floor(F.col("taken") / F.col("size")).cast("int")),
                    F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    out = whole.join(rows, ["_k1", "_k2", "dup"]).select("_row", F.explode(uses).alias("first"))
    text = F.col("_row")["text"]
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("first").cast("int")), " ")
    text = F.when(F.col("first") > 0, cut).otherwise(text)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("first") > 0, F.length(text).cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("_row")["n_chars"])
    return unpacked(out, docs.columns, **new)

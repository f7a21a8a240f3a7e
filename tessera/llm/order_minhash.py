"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles (A-Z lower-cased, blanks
dropped; fewer than five words are one shingle). Two texts are near when their
ordered similarity LCS / (n1 + n2 - LCS) is at least ``SIMILARITY``; in that
case at most (n1 + n2) / 9 shingles lie outside the common subsequence, which
is the width of the alignment's band, so the banded result is exact.

1. Copies: texts of equal words are one node (128-bit hash).
2. Sketches: a shingle is labelled with its occurrence number; each of
   ``SKETCHES`` hash functions takes the ``TAKEN`` smallest labelled shingles,
   puts them back into text order and hashes them to a key. At similarity 0.8
   two texts share none of 16 such keys in about one case of 100 000.
3. Star round: in every bucket (equal key) each node is paired with the bucket's
   best connected node; distinct pairs are aligned and components formed.
4. Rest round: a bucket whose nodes are now in one component needs nothing
   more. In the others each node outside the largest component meets the nodes
   of other components, block by block. A pair is looked at in the first of the
   buckets it shares, by the exact number of labelled shingles both hold (an
   upper bound of the common subsequence), aligned if that reaches the
   threshold, the likeliest first, and left out once its two components are
   linked. A block gives the links that joined components, never its pairs, so
   rows grow with the nodes, and no pair that shares a key goes untested.

Scale: rows of buckets are three numbers; texts travel as 32-bit word hashes and
only to star pairs and to blocks (bounded in nodes and in words) of buckets that
still hold several components. Groups of any size are met as stars, blocks and
joins between written tables, never as one group in a task. Very long texts are
aligned in a window as wide as the band.

Defined cases: NULL text is the empty text; texts without words are copies of
each other; rows that repeat in full count as one document (``drop_near`` keeps
one of them);
ties of doc_id are broken by content; a NULL doc_id sorts last; an empty table
gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, packed, row_keys, rows_and, text_of, unpacked
from tessera.llm.graph import components

WORDS = 5                      # words of a shingle
SIMILARITY = 0.8
SKETCHES, TAKEN = 16, 3
BLOCK, BLOCK_WORDS = 1024, 2_000_000      # nodes and words of one side of a block, about
CALL_ROWS = 128                # rows of small buckets compared in one call, about
_SEEDS = np.random.default_rng(4).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)


# ---- texts to sketches ------------------------------------------------------

def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8").lower().split()
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))


def shingles(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """64-bit hashes of the k-word windows, in order."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    k = min(k, len(words))
    h = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        h = (h ^ words[i:len(words) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def occurrences(s: np.ndarray) -> np.ndarray:
    """Shingles labelled with their occurrence number, as new hashes."""
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    n = np.empty(len(s), dtype=np.uint64)
    n[order] = (np.arange(len(s)) - first).astype(np.uint64)
    return (s + n * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xBF58476D1CE4E5B9)


def sketch(s: np.ndarray) -> list[int]:
    """Order MinHash keys of a shingle sequence."""
    if not len(s):
        return []
    x = occurrences(s)
    x ^= x >> np.uint64(31)
    keys = []
    for i in range(SKETCHES):
        h = x * _SEEDS[i]
        h ^= h >> np.uint64(32)
        low = np.sort(np.argpartition(h, TAKEN - 1)[:TAKEN]) if len(h) > TAKEN else np.arange(len(h))
        keys.append(xxhash.xxh3_64_intdigest(x[low].tobytes(), i) - (1 << 63))
    return keys


# ---- alignment --------------------------------------------------------------

def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def banded_lcs(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence with matches at most ``band`` off the
    diagonal: bit-parallel, one row per element of b. Only the bits of the band
    are held: those above it are still ones, those below it don't change."""
    head = _common(a, b)
    a, b = a[head:], b[head:]
    tail = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    at = defaultdict(list)
    for i, x in enumerate(a.tolist()):
        at[x].append(i)
    masks = {x: sum(1 << i for i in p) for x, p in at.items() if len(p) > 256}
    low, high, met = 0, 0, 0               # v holds the bits low..high-1
    v = 0
    for j, y in enumerate(b.tolist()):
        if j - band > low:                 # low moves by one a row
            met += not v & 1
            v >>= 1
            low += 1
        if low >= len(a):
            break
        top = min(len(a), j + band + 1)
        v |= ((1 << (top - high)) - 1) << (high - low)
        high = top
        full = (1 << (high - low)) - 1
        if y in masks:
            m = masks[y] >> low & full
        else:
            m = 0
            for i in at.get(y, ()):
                if low <= i < high:
                    m |= 1 << (i - low)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return head + tail + met + (high - low) - v.bit_count()


def needed(n_a: int, n_b: int, similarity: float) -> float:
    """The common subsequence that two lengths need for the threshold."""
    return similarity / (1 + similarity) * (n_a + n_b) - 1e-9


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the sequences' ordered similarity reaches the threshold."""
    need = needed(len(a), len(b), similarity)
    return banded_lcs(a, b, int(len(a) + len(b) - 2 * need) + 1) >= need


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """The same, the cheap bounds first."""
    need = needed(len(a), len(b), similarity)
    if min(len(a), len(b)) < need or not len(a) + len(b):
        return False
    values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    met = np.minimum(np.bincount(where[:len(a)], minlength=len(values)), np.bincount(where[len(a):], minlength=len(values)))
    return met.sum() >= need and aligned(a, b, similarity)    # even without regard to order enough


# ---- Spark ------------------------------------------------------------------

def _sketched(docs: DataFrame) -> DataFrame:
    """_k1, _k2, doc_id, node (64 bits of the copy key), n, keys, words of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["text"]:
                w = word_hashes(t)
                s = shingles(w)
                d = xxhash.xxh3_128_digest(b" ".join(t.encode("utf-8").lower().split()))
                out.append((np.frombuffer(d, dtype=np.int64).tolist()[0], len(s), sketch(s), w.tobytes()))
            f = pd.DataFrame(out, columns=["node", "n", "keys", "words"])
            f.insert(0, "doc_id", b["doc_id"].astype("Int64").to_numpy())
            f.insert(0, "_k2", b["_k2"].to_numpy())
            f.insert(0, "_k1", b["_k1"].to_numpy())
            yield f

    rows = docs.select(*row_keys("doc_id", "text"), F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInPandas(run, "_k1 long, _k2 long, doc_id long, node long, n int, keys array<long>, words binary")


def _aligned(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are near."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            hit = [near(shingles(np.frombuffer(x, dtype=np.uint32)), shingles(np.frombuffer(y, dtype=np.uint32)), similarity)
                   for x, y in zip(p["wa"], p["wb"])]
            yield p.loc[np.array(hit, dtype=bool), ["a", "b"]]

    of = nodes.select("node", "words")
    return (pairs.join(of.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a")
            .join(of.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b")
            .mapInPandas(run, "a long, b long"))


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _block_links(g: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    """Links that join components among the probes and homes of some buckets."""
    g = g.sort_values(["bucket", "i", "home"])
    ids, n, home, index = (g[c].to_numpy() for c in ("node", "n", "home", "i"))
    _, part = np.unique(g["component"].to_numpy(), return_inverse=True)
    keys = np.array(g["keys"].tolist(), dtype=np.int64)
    rows = [shingles(np.frombuffer(w, dtype=np.uint32)) for w in g["words"]]
    names, flat = np.unique(np.concatenate([occurrences(r) for r in rows]), return_inverse=True)
    ends = np.cumsum([len(r) for r in rows])
    labelled = np.split(flat.astype(np.int32), ends[:-1])
    held = np.zeros(len(names), dtype=bool)
    bucket = g["bucket"].to_numpy()
    edges = np.r_[0, np.flatnonzero((bucket[1:] != bucket[:-1]) | (index[1:] != index[:-1])) + 1, len(g)]
    links = []
    for lo, hi in zip(edges, edges[1:]):                   # one bucket (or a block of one): probes, then homes
        mid = lo + int(np.count_nonzero(~home[lo:hi]))
        for p in range(lo, mid):
            fit = ((part[mid:hi] != part[p])
                   & (np.minimum(n[mid:hi], n[p]) >= similarity * np.maximum(n[mid:hi], n[p]) - 1e-6)
                   & ~(keys[mid:hi, :index[lo]] == keys[p, :index[lo]]).any(axis=1))
            hits = mid + np.flatnonzero(fit)
            if not len(hits):
                continue
            held[labelled[p]] = True
            starts = np.cumsum(n[hits]) - n[hits]
            met = np.add.reduceat(held[np.concatenate([labelled[h] for h in hits])].astype(np.int32), starts)
            held[labelled[p]] = False
            enough = met >= similarity / (1 + similarity) * (n[hits] + n[p]) - 1e-6
            hits, met = hits[enough], met[enough]
            for h in hits[np.lexsort((ids[hits], -met / (n[hits] + n[p])))]:
                if part[h] != part[p] and aligned(rows[p], rows[h], similarity):
                    links.append((min(ids[p], ids[h]), max(ids[p], ids[h])))
                    part[part == part[h]] = part[p]
    return links


def _rest_links(buckets: DataFrame, nodes: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join components, of buckets that hold several."""
    state = nodes.select("node", "n").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = materialize(buckets.join(state, "node"), "rest-rows")            # bucket, i, node, n, component
    per = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))

    def blocks(nodes_: str, words: str):
        return F.ceil(F.greatest(F.expr(nodes_) / BLOCK, F.expr(words) / BLOCK_WORDS)).cast("int")

    top = (per.groupBy("bucket").agg(F.max(F.struct("c", "component", "w")).alias("top"), F.sum("c").alias("c"), F.sum("w").alias("w"))
           .where("top.c < c")
           .select("bucket", F.col("top.component").alias("main"), blocks("c", "w").alias("hs"),
                   blocks("c - top.c", "w - top.w").alias("ps")))
    members = materialize(rows.join(materialize(top, "rest-buckets"), "bucket"), "rest-members")
    size = rows_and(members, F.sum("n").alias("words"))
    calls = F.lit(max(1, -(-size["n"] // CALL_ROWS), -(-(size["words"] or 0) // BLOCK_WORDS)))

    hashed = F.xxhash64(F.lit(5), "node")
    home = F.pmod(hashed, "hs").cast("int")
    probe = F.pmod(hashed, "ps").cast("int")

    def place(hb, pb, is_home: bool):
        return F.struct(hb.alias("hb"), pb.alias("pb"), F.lit(is_home).alias("home"))

    places = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("ps") - 1), lambda p: place(home, p, True)),
        F.when(F.col("component") != F.col("main"), F.transform(F.sequence(F.lit(0), F.col("hs") - 1), lambda h: place(h, probe, False)))
        .otherwise(F.array()))
    # Buckets of one block go to a task's call by the hundred rows, others by block.
    small = (F.col("hs") == 1) & (F.col("ps") == 1)
    call = F.when(small, F.pmod("bucket", calls)).otherwise(F.col("bucket"))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_block_links(g, similarity), columns=["a", "b"]).astype("int64")

    return (members.join(nodes.select("node", "keys", "words"), "node")
            .select("bucket", "i", "node", "n", "component", "keys", "words", call.alias("call"), small.alias("small"),
                    F.explode(places).alias("place"))
            .select("*", "place.*").drop("place")
            .groupBy("call", "small", "hb", "pb").applyInPandas(run, "a long, b long").distinct())


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): the rows with their node, and node, component of every
    node that is near another."""
    rows = materialize(_sketched(docs), "sketched")
    nodes = materialize(rows.groupBy("node").agg(
        F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("words").alias("words")), "near-nodes")
    keyed = (nodes.select("node", F.posexplode("keys").alias("i", "key"))
             .select(F.xxhash64("i", "key").alias("bucket"), "i", "node"))
    sizes = materialize(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bucket-sizes")
    buckets = materialize(keyed.join(sizes, "bucket"), "buckets")

    support = buckets.groupBy("node").agg(F.sum(F.col("size") - 1).alias("support"))     # a node has few rows
    centres = (buckets.join(support, "node").groupBy("bucket")
               .agg(F.max_by("node", F.struct("support", "node")).alias("centre")))
    pairs = (buckets.join(materialize(centres, "centres"), "bucket").where("node <> centre")
             .select(*_ordered("node", "centre")).distinct())
    parts = materialize(components(_aligned(materialize(pairs, "pairs"), nodes, similarity)), "parts").withColumnRenamed("id", "node")

    found = materialize(_rest_links(buckets.select("bucket", "i", "node"), nodes, parts, similarity), "rest-links")
    if found.limit(1).count():
        # The parts so far, as stars, and what joins them.
        stars = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        parts = materialize(components(stars.unionByName(found)), "parts").withColumnRenamed("id", "node")
    return rows, parts


def _members(docs: DataFrame, similarity: float) -> DataFrame:
    """_k1, _k2, doc_id, component of every row, and the class's smallest
    (doc_id, content) as ``least``."""
    rows, parts = near_classes(docs, similarity)
    rows = (rows.select("_k1", "_k2", "doc_id", "node").join(parts, "node", "left")
            .select("_k1", "_k2", "doc_id", F.coalesce("component", "node").alias("component")))
    rows = materialize(rows, "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_k1", "_k2")
    least = materialize(rows.groupBy("component").agg(F.min(place).alias("least")), "near-least")
    return rows.join(least, "component")


def near_report(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), kept of every row."""
    own = F.struct("_k1", "_k2") == F.struct("least._k1", "least._k2")
    return _members(docs, similarity).select("doc_id", F.col("least.doc_id").alias("class_id"), own.alias("kept"))


def drop_near(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, same columns; of rows that repeat in full one."""
    first = (_members(docs, similarity).where("_k1 = least._k1 and _k2 = least._k2")
             .select("_k1", "_k2").distinct())
    once = packed(docs, *row_keys("doc_id", "text")).groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
    return unpacked(once.join(first, ["_k1", "_k2"]), docs.columns)

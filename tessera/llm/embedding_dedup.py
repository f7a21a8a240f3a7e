"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

1. Equal vectors are one node with a count; nodes that share a vec_id are
   connected, though not linked.
2. Centres come from spherical k-means on a bounded sample (``SAMPLE_PER_CELL``
   per centre, at most ``MAX_CELLS`` centres); every vector is assigned to its
   nearest centre and is also compared in each cell whose border is near enough
   that a partner at the threshold may lie behind it. Partners in two cells are
   at most sqrt(2 - 2t) apart and the plane between the centres separates them,
   so one of them is within half of that, sqrt((1 - t) / 2), of the plane: no
   pair is lost, whatever the data.
3. A cell's own vectors are cut into blocks of about ``BLOCK``, those that probe
   it into blocks of about ``PROBE_BLOCK``; a task holds one pair of blocks and
   multiplies ``SLICE`` rows at once in double precision, whatever the size of
   the cell.
4. Tasks give counts of links per vector and, for connection only, an edge from
   each vector to the smallest id of its connected part: never all pairs.
   Every link is counted where its vector is the one that probes, or, if the
   partner's cell doesn't probe back, for both.
5. Components of those edges; the smallest id of each is kept.

Defined cases: a vector that is NULL, empty, zero or holds NULL or non-finite
components links with nothing and is its own component; only vectors of one
width compare; rows that repeat in full are one vector and get equal results;
rows that share a vec_id but hold other vectors are vectors of their own, each
with its links, in one component; a NULL vec_id links with nothing and is its own, kept, component;
an empty table gives an empty result; a tie with the threshold is a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.graph import components

THRESHOLD = 0.9
PER_CELL = 2000                # vectors a cell aims at
MAX_CELLS = 4096
SAMPLE_PER_CELL = 16
ROUNDING = 1e-6                # added to the reach
BLOCK, PROBE_BLOCK = 4096, 8192
SLICE = 512


def fit_cells(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of spherical k-means over unit rows; the first k rows start."""
    k = max(1, min(k, len(x)))
    centres = x[:k].copy()
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def near_cells(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, list[list[int]]]:
    """(home, cells to probe, home included) of unit rows."""
    reach = np.sqrt(max(0.0, (1 - threshold) / 2)) + ROUNDING
    homes, cells = [], []
    for at in range(0, len(x), SLICE):                     # rows x cells numbers at once
        dots = x[at:at + SLICE] @ centres.T
        rows = np.arange(len(dots))
        home = dots.argmax(axis=1)
        gap = dots[rows, home][:, None] - dots
        near = gap <= reach * np.sqrt(np.maximum(1e-12, 2 - 2 * centres[home] @ centres.T))
        near[rows, home] = True
        homes.append(home)
        cells += [np.flatnonzero(r).tolist() for r in near]
    return np.concatenate(homes), cells


def unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def local_parts(linked: np.ndarray, row_ids: np.ndarray, col_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id in the connected part of each row and column that has a link."""
    big = np.iinfo(np.int64).max
    rows, cols = row_ids.copy(), col_ids.copy()
    r, c = np.nonzero(linked)
    while True:
        before = rows.copy(), cols.copy()
        low = np.full(len(rows), big)
        np.minimum.at(low, r, cols[c])
        rows = np.minimum(rows, low)
        low = np.full(len(cols), big)
        np.minimum.at(low, c, rows[r])
        cols = np.minimum(cols, low)
        if (before[0] == rows).all() and (before[1] == cols).all():
            return rows, cols


def vectors_of(vectors: DataFrame) -> DataFrame:
    """Usable vectors, one row per distinct (id, vector), with two hashes of the vector."""
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    return (vectors.where(usable).select(F.col("vec_id").cast("long").alias("id"), "embedding", *_hashes())
            .groupBy("id", "k1", "k2").agg(F.first("embedding").alias("embedding")))


def _hashes() -> list:
    return [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(71), "embedding").alias("k2")]


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, per_cell: int = PER_CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    ids = materialize(vectors_of(vectors), "vectors")
    # Written once, so a node keeps its number.
    nodes = materialize(ids.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("members"), F.first("embedding").alias("embedding"))
                        .withColumn("width", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    ids = materialize(ids.select("id", "k1", "k2").join(nodes.select("k1", "k2", "node"), ["k1", "k2"]), "vector-ids")

    n = nodes.groupBy("width").count().collect()          # one row per width
    centres = {}
    for r in n:
        k = min(MAX_CELLS, r["count"] // per_cell + 1)
        rows = (nodes.where(F.col("width") == r["width"]).orderBy("k1", "k2")
                .limit(k * SAMPLE_PER_CELL).select("embedding").toArrow())
        sample = np.asarray(rows["embedding"].combine_chunks().flatten(), dtype=np.float64).reshape(-1, r["width"])
        centres[r["width"]] = fit_cells(unit(sample), k)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for width, g in b.groupby("width"):
                g = g.copy()
                g["home"], g["probes"] = near_cells(unit(g["embedding"]), shared.value[width], threshold)
                yield g

    kind = nodes.schema["embedding"].dataType.simpleString()
    schema = f"node long, members long, embedding {kind}, width int"
    placed = materialize(nodes.select("node", "members", "embedding", "width")
                         .mapInPandas(assign, f"{schema}, home int, probes array<int>"), "vector-cells")
    met = placed.withColumn("cell", F.explode("probes"))
    sizes = met.groupBy("width", "cell").agg(
        F.ceil(F.count_if(F.col("cell") == F.col("home")) / BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.count(F.lit(1)) / PROBE_BLOCK).cast("int").alias("probe_blocks"))
    sizes = materialize(sizes, "cell-sizes")               # at most MAX_CELLS rows a width

    def dealt(blocks: str):
        return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    homes = (placed.withColumn("cell", F.col("home")).join(F.broadcast(sizes), ["width", "cell"])
             .select("*", dealt("home_blocks").alias("hb"), every("probe_blocks").alias("pb"), F.lit(True).alias("is_home")))
    probes = (met.join(F.broadcast(sizes), ["width", "cell"]).where("home_blocks > 0")
              .select("*", every("home_blocks").alias("hb"), dealt("probe_blocks").alias("pb"), F.lit(False).alias("is_home")))

    def compare(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        h, p = g[g["is_home"]], g[~g["is_home"]]
        empty = pd.DataFrame({"node": [], "n": [], "part": []}).astype("int64")
        if h.empty or p.empty:
            return empty
        hid, pid = h["node"].to_numpy(), p["node"].to_numpy()
        x, y = unit(p["embedding"]), unit(h["embedding"]).T
        many_h, many_p = h["members"].to_numpy(dtype=np.float64), p["members"].to_numpy(dtype=np.float64)
        cells, where = np.unique(p["home"].to_numpy(), return_inverse=True)
        back = np.array([np.isin(cells, c) for c in h["probes"]]).T        # (cell, home vector): probed by it
        linked = np.empty((len(x), y.shape[1]), dtype=bool)
        n_p, n_h = np.zeros(len(x)), np.zeros(y.shape[1])
        for i in range(0, len(x), SLICE):
            s = slice(i, i + SLICE)
            linked[s] = (x[s] @ y >= threshold) & (pid[s, None] != hid[None, :])
            if linked[s].any():
                n_p[s] = linked[s] @ many_h
                n_h += many_p[s] @ (linked[s] & ~back[where[s]])           # pairs that are met here only
        if not linked.any():
            return empty
        rows, cols = local_parts(linked, pid, hid)
        in_p, in_h = linked.any(axis=1), linked.any(axis=0)
        # A vector may stand on both sides, in two parts of this block: an edge for each.
        return pd.DataFrame({"node": np.r_[pid[in_p], hid[in_h]], "n": np.r_[n_p[in_p], n_h[in_h]],
                             "part": np.r_[rows[in_p], cols[in_h]]}).astype("int64")

    found = materialize(homes.unionByName(probes).groupBy("width", "cell", "hb", "pb")
                        .applyInPandas(compare, "node long, n long, part long"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    shared_ids = ids.groupBy("id").agg(F.min("node").alias("part"), F.max("node").alias("last")).where("part < last").drop("last")
    edges = found.select("node", "part").unionByName(ids.join(shared_ids, "id").select("node", "part"))
    parts = components(edges, "node", "part").withColumnRenamed("id", "node")
    # Written tables on both sides of each join, so that Spark can split a hot vector or component.
    state = materialize(nodes.select("node", "members").join(counts, "node", "left").join(parts, "node", "left")
                        .select("node", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"),
                                F.coalesce("component", "node").alias("component")), "vector-state")
    known = materialize(ids.join(state, "node").drop("node"), "vector-known")
    least = materialize(known.groupBy("component").agg(F.min("id").alias("component_id")), "vector-least")
    known = known.join(least, "component").select("id", F.struct("k1", "k2").alias("k"), "n_links", "component_id")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(*_hashes()).alias("own"))
    out = rows.join(known, (F.col("vec_id") == F.col("id")) & (F.col("own") == F.col("k")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

"""Labelled rows as feature vectors: all of them fit a model, in chunks.

A model is fitted by parameter mixing: every labelled row is in one chunk, dealt
by a hash of its content; each chunk fits parameters of its own in a task, and
the model's are their mean, weighted by rows. A chunk has about ``CHUNK_ROWS``
rows whatever the table's size; with fewer rows there is one chunk."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import features
from tessera.llm.common import materialize

CHUNK_ROWS = 3000              # rows that are fitted at once
WIDTH = features.FAMILIES * features.BUCKETS + len(features.DENSE)


def vector(text: bytes) -> np.ndarray:
    """Hashed n-grams, then the dense shares."""
    words = text.split()
    ids = features.word_ids(words)
    return np.concatenate([features.hashed(text, words),
                           features.dense(text, features.basics(text, words, ids), ids)])


def _marked(labels: DataFrame, only: Column | None) -> DataFrame:
    """doc_id, quality: labels 0 and 1 by id; an id labelled twice counts as 0 if
    any label says so. NULL ids are left out."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    if only is not None:
        marked = marked.where(only)
    return marked.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))


def fit_in_chunks(docs: DataFrame, labels: DataFrame, fit: Callable[[np.ndarray, np.ndarray], np.ndarray | None],
                  only: Column | None = None, chunk_rows: int = CHUNK_ROWS) -> tuple[np.ndarray | None, int, int]:
    """(parameters, rows, rows labelled 1) over all labelled rows; ``fit`` makes
    parameters of one chunk's vectors and labels, or none if nothing can be
    learned from them. Parameters are None if no chunk gave any. An id that
    several documents have gives a row each."""
    marked = _marked(labels, only)
    n_chunks = max(1, round(marked.count() / chunk_rows))
    wide = docs.where("doc_id IS NOT NULL")
    if only is not None:
        wide = wide.where(only)
    # Labels grow with the documents: one plan at any size. Written before the
    # rows go to their chunks, so that the join's shuffle files go first.
    rows = materialize(
        wide.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(marked.hint("merge"), "doc_id")
        .select("quality", "text", F.xxhash64("doc_id", "text").alias("h")), "labelled-rows", compression="zstd")

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "quality"], kind="stable")
        out, parts = [], max(1, round(len(group) / chunk_rows))      # an id of very many documents
        for k in range(parts):
            part = group.iloc[k::parts]
            x = np.zeros((len(part), WIDTH), dtype=np.float32)
            for row, t in zip(x, part["text"]):
                row[:] = vector(t.encode("utf-8")).astype(np.float16)
            y = part["quality"].to_numpy(dtype=np.float64)
            found = fit(x, y)
            out.append((len(y), int(y.sum()), None if found is None else np.asarray(found, dtype=np.float64)))
        return pd.DataFrame(out, columns=["n", "ones", "params"])

    fits = materialize(rows.groupBy(F.pmod("h", F.lit(n_chunks)).alias("chunk"))
                       .applyInPandas(run, "n long, ones long, params array<double>"), "labelled-fits")
    facts = fits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("ones"), F.lit(0)).alias("ones"),
                     F.sum(F.when(F.col("params").isNotNull(), F.col("n"))).alias("fitted")).first()
    if facts["fitted"] is None:
        return None, facts["n"], facts["ones"]
    mean = (fits.select("n", F.posexplode("params").alias("pos", "p")).groupBy("pos")
            .agg(F.sum(F.col("n") * F.col("p")).alias("p")).collect())      # one row a parameter
    params = np.zeros(len(mean))
    for r in mean:
        params[r["pos"]] = r["p"] / facts["fitted"]
    return params, facts["n"], facts["ones"]


def sample(docs: DataFrame, labels: DataFrame, rows: int, only: Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For looking at a few rows; models take all (``fit_in_chunks``).
    (X, y) of at most ``rows`` labelled documents, those of the smallest
    hashes of doc_id. Labels other than 0 and 1 and NULL ids are left out; an id
    labelled twice counts as 0 if any label says so; an id that several
    documents have gives a row each, again cut to ``rows`` by content hash.
    Features are made on the executors; the driver gets the numbers other than 0
    in half precision, and holds the one matrix that is returned."""
    chosen = _marked(labels, only).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, x = [], []
            for t in b["text"]:
                v = vector(t.encode("utf-8")).astype(np.float16)
                some = v.nonzero()[0]
                at.append(some.astype("<u2").tobytes())
                x.append(v[some].tobytes())
            yield pd.DataFrame({"quality": b["quality"], "h": b["h"], "at": at, "x": x})

    text = F.coalesce("text", F.lit(""))
    # At most `rows` ids: the broadcast has that bound.
    joined = (docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
              .select("quality", "text", F.xxhash64("doc_id", "text").alias("h")))
    got = (joined.mapInPandas(run, "quality int, h long, at binary, x binary")
           .orderBy("h", "quality").limit(rows).collect())
    matrix = np.zeros((len(got), WIDTH), dtype=np.float32)
    for row, r in zip(matrix, got):
        row[np.frombuffer(r["at"], dtype="<u2")] = np.frombuffer(r["x"], dtype=np.float16)
    return matrix, np.array([r["quality"] for r in got], dtype=np.float64)

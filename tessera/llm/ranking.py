"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in its features (hashed n-grams and dense
shares). Preference pairs say that a document labelled 1 beats one labelled 0;
weights are learned by logistic loss on the difference of the pair's features.
The threshold is a quantile of the training scores: the share of label 0 among
them. Scores are mapped to 0..1 with that threshold at one half and a slope
calibrated on held-back rows.

Training takes all labelled rows, in chunks whose parameters are averaged
(``labelled.fit_in_chunks``); every chunk deals ``PAIRS`` pairs from its rows by
a fixed rule, enough for every row. Scoring is one narrow pass over whole texts.

Defined cases: NULL text is the empty text and is scored like any other;
repeated rows get equal scores; with no label of one kind every text scores the
observed share; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import features
from tessera.llm.labelled import WIDTH, fit_in_chunks, vector

PAIRS = 12_000                 # preference pairs per chunk
FOLDS, HELD_OUT = 3, 1         # crc32(doc_id as text) mod 3 = 1 is never learned from


class Ranker(NamedTuple):
    weights: np.ndarray
    threshold: float
    slope: float
    base: float                # score of any text if nothing could be learned

    def score(self, x: np.ndarray) -> float:
        if not self.weights.any():
            return self.base
        return float(features.sigmoid(np.float64(self.slope * (float(x @ self.weights) - self.threshold))))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows of the held-out fold; a NULL id is in none."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


def preference_pairs(y: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (better, worse): every row in turn against a row of the other
    label, at strides without a common pattern."""
    good, bad = np.flatnonzero(y > 0), np.flatnonzero(y <= 0)
    i = np.arange(pairs)
    return good[i % len(good)], bad[(i * 7919 + i // len(good)) % len(bad)]


def train(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS) -> Ranker:
    width = x.shape[1]
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return Ranker(np.zeros(width, np.float32), 0.0, 1.0, float((y.sum() + 1) / (len(y) + 2)))
    last = np.arange(len(y)) % 5 == 4
    if not 0 < y[last].sum() < last.sum() or not 0 < y[~last].sum() < (~last).sum():
        last[:] = False
    rows = np.flatnonzero(~last)        # rows are left out by number, no part of the matrix is copied
    better, worse = (rows[i] for i in preference_pairs(y[rows], pairs))
    scale = np.concatenate([np.full(width - len(features.DENSE), 20.0), np.full(len(features.DENSE), 5.0)]).astype(np.float32)

    def gradient(w: np.ndarray) -> np.ndarray:
        s = x @ (scale * w).astype(np.float32)
        loss = features.sigmoid(s[better] - s[worse]) - 1           # d/ds of -log sigma(difference)
        pull = np.bincount(better, loss, len(y)) - np.bincount(worse, loss, len(y))
        return scale * (pull.astype(np.float32) @ x) / len(better) + 1e-4 * w

    weights = (scale * features.descend(gradient, width, 150, 0.02)).astype(np.float32)
    rest = last if last.any() else ~last
    raw = (x @ weights)[rest]
    threshold = float(np.quantile(raw, float(1 - y[rest].mean())))
    slope, _ = features.calibrate(raw - threshold, y[rest])
    return Ranker(weights, threshold, slope, 0.5)


def score_documents(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ranker)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scores = [shared.value.score(vector(t.encode("utf-8"))) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"],
                                "score": np.array(scores, dtype=np.float64)})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return (narrow.mapInPandas(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """A chunk's parameters: the weights, threshold and slope."""
    found = train(x, y)
    return np.append(found.weights, [found.threshold, found.slope]) if found.weights.any() else None


def rank_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    params, n, ones = fit_in_chunks(docs, labels, fit, ~held_out())
    if params is None:
        ranker = Ranker(np.zeros(WIDTH, np.float32), 0.0, 1.0, (ones + 1) / (n + 2))
    else:
        ranker = Ranker(params[:-2].astype(np.float32), float(params[-2]), float(params[-1]), 0.5)
    return score_documents(docs, ranker)

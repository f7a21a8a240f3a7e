"""Quality rules: a hashed n-gram logistic regression behind plain base rules.

Training takes all labelled rows, in chunks whose parameters are averaged
(``labelled.fit_in_chunks``): four fifths of a chunk fit the regression on
hashed word and character n-grams, the last fifth calibrates its probabilities
(Platt). Scoring is one
narrow pass in Arrow batches over whole texts with a weight vector of fixed
size; verdicts use fixed thresholds.

Defined cases: NULL text is the empty text; texts under ``min_words`` words fail
the base rules whatever the model says; repeated rows get equal results; with
no label of one kind the model gives the observed share to every text; an empty
table gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tessera.llm import features
from tessera.llm.common import packed, unpacked
from tessera.llm.labelled import fit_in_chunks

MIN_WORDS = 50                 # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50        # base rule: more words in repeated 3-word windows fail
KEEP_FROM = 0.5                # model rule: calibrated probability of quality 1
_HASHED = features.FAMILIES * features.BUCKETS


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, x: np.ndarray) -> float:
        raw = float(x @ self.weights) + self.bias
        return float(features.sigmoid(np.float64(self.slope * raw + self.shift)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """A chunk's parameters: the weights, bias, slope and shift."""
    x = x[:, :_HASHED]                  # a view: rows are left out by weight, no part of the matrix is copied
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return None
    last = np.arange(len(y)) % 5 == 4
    if not 0 < y[last].sum() < last.sum():
        last[:] = True
    taken = ~last if not last.all() else last

    def gradient(w: np.ndarray) -> np.ndarray:
        r = taken * (features.sigmoid(x @ w[:-1].astype(np.float32) * 20 + w[-1]) - y)
        return np.append(20 * (r.astype(np.float32) @ x) / taken.sum() + 1e-4 * w[:-1], r.sum() / taken.sum())

    w = features.descend(gradient, _HASHED + 1, 150, 0.02)
    weights = (20 * w[:-1]).astype(np.float32)
    slope, shift = features.calibrate((x @ weights)[last] + w[-1], y[last])
    return np.append(weights, [w[-1], slope, shift])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    params, n, ones = fit_in_chunks(docs, labels, fit)
    if params is None:
        share = (ones + 1) / (n + 2)
        return Model(np.zeros(_HASHED, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    return Model(params[:-3].astype(np.float32), *map(float, params[-3:]))


_SCORED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, probability double, kept boolean")


def judge(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM, min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT, carry: str = "doc_id") -> DataFrame:
    """``carry`` (a column) and the verdict columns of every row."""
    schema = StructType([docs.schema[carry], *StructType.fromDDL(_SCORED)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            texts = b.column("text") if "text" in b.schema.names else pc.struct_field(b.column(carry), "text")
            out = []
            for t in texts.to_pylist():
                raw = (t or "").encode("utf-8")
                words = raw.split()
                s = features.basics(raw, words, features.word_ids(words))
                failed = s.n_words < min_words or 100 * s.n_repeat_words > max_repeat_percent * s.n_words
                p = m.probability(features.hashed(raw, words))
                out.append((*s, failed, p, not failed and p >= keep_from))
            names = [f.split(" ")[0] for f in _SCORED.split(", ")]
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            cols = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column(carry), *[pa.array(c, type=k) for c, k in zip(cols, types)]], names=[carry, *names])

    needed = [carry] if carry == "_row" else [carry, "text"]
    return docs.select(*needed).mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, train(docs, labels))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, same columns, that pass."""
    whole = packed(docs)
    judged = judge(whole, train(docs, labels), carry="_row")
    return unpacked(judged.where("kept"), docs.columns)

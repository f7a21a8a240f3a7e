"""LM scoring: hashed-context bit predictors, logistically mixed.

The model codes a text as its words (ASCII blanks dropped, A-Z lower-cased) and
an end token; a word is its bytes and a closing blank, a byte eight bits from
the top. For every bit, predictors look up the ones and zeros seen in a hashed
context: two and four bytes back, and the whole word so far, each together with
the document's class. Their log odds are mixed with weights that a gate chooses
by how much the contexts have seen; a table refines the result by how such
predictions came true (adaptive probability map). All are proper binary
predictions, so ``score`` is a probability; the class itself costs
log10(1 / CLASSES).

Training, over all training documents:
1. classes: spherical k-means on byte-pair profiles; ``CLASS_ROUNDS`` rounds over
   all training documents, begun at the centres of some (``CLASS_ROWS``);
2. word counts by class: pre-aggregated in the tasks, summed by a shuffle whose
   rows follow the corpus's vocabulary; words of held-out documents alone are
   rows of count zero;
3. context counts: every (class, word) with its count goes through its bits
   into tables of fixed size; tasks emit them as blocks, summed per block;
4. mixing weights and refinement: online passes over all training tokens (every
   (class, word) row with its count), one a batch of rows, are averaged by the
   bits that each gate met; from there, rounds of Newton steps on the loss of all
   training tokens until one saves next to nothing (``SETTLED``). The refinement
   counts all training tokens. A word's own occurrence is taken out of the counts
   it reads.

A word's bits depend on its class and the word so far alone, so steps 3 and 4 and
the scoring take words in order, by ranges, and handle a beginning that
neighbours share once, with their summed count.

Scoring: every distinct (class, word) is scored once, and a document's score is
the sum over its words. The commonest rows (at most ``TOP_WORDS``) are broadcast
with their scores and the counts that the base score needs, the others are
joined.

Defined cases: NULL text is the empty text (one end token); rows that repeat
get equal results; NULL doc_id counts as training text and stays NULL; without
training rows the model is uniform and the base N = V = 0; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

CLASSES = 6
CLASS_ROWS = 1500                      # where classes begin
CLASS_ROUNDS = 2                       # rounds of k-means over all training rows
MIX_TASK = 50_000                      # (class, word) rows that one task of the mixer's rounds or of the scoring takes
SETTLED = 1e-5                         # the mixer's rounds end with a step that should save no more of the loss
_ONLINE_STEPS = 5                      # at most, on the bits at hand
TOP_WORDS = 150_000                    # (class, word) rows broadcast
FOLDS, HELD_OUT = 7, 2                 # crc32(doc_id as text) mod 7 = 2 is held out
TABLE_BITS = (19, 20, 21, 22)          # slots of the contexts: two, three and five bytes, word so far
WORDS_PER_TABLE = 500_000              # (class, word) rows that one counting task takes
END = b"\n"                            # the end token; no word holds a blank
_PROFILE = 1024
_BLOCK = 1 << 16
_PARTS = 64                            # partial blocks that one task sums
_SUMS = 512                            # numbers of a task's sums that one row holds
_FLUSH = 400_000
_SLICE = 200                           # texts whose words are looked up at once
_CHUNK = 150_000                       # bytes counted at once
_SCORED = 60_000                       # bytes scored at once, so that their arrays stay in a core's cache
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


# ---- words to contexts ------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Edges(NamedTuple):
    """The bytes of some words; one that the word before has too, after the same
    bytes and in the same class, stands for both."""
    byte: np.ndarray
    slots: list[np.ndarray]            # first slot by table
    word: np.ndarray                   # word number of every byte of every word
    edge: np.ndarray                   # and which of ``byte`` stands for it

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """How often each occurs if the words occur ``counts`` times."""
        return np.bincount(self.edge, counts[self.word], len(self.byte))


def edges(words: list[bytes], classes: np.ndarray) -> Edges:
    flat = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    pos = np.arange(len(flat)) - starts[word]
    # The same place of the word before; past its end, its closing blank has differed already.
    differs = flat != flat[np.arange(len(flat)) - np.repeat(np.append(0, lengths[:-1]), lengths)]
    differs[starts[np.append(True, classes[1:] != classes[:-1])]] = True
    met = np.cumsum(differs)
    fresh = met > (met[starts] - differs[starts])[word]
    # By place, a byte that is not fresh directly follows the one it shares.
    order = np.argsort(pos.astype(np.uint16) if lengths.max() < 1 << 16 else pos, kind="stable")
    by_place = fresh[order]
    at = order[by_place]

    b, own, place = flat.astype(np.uint64) + np.uint64(1), word[at], pos[at]
    salt = (classes[own].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)

    def back(k: int) -> np.ndarray:
        return np.where(place >= k, b[np.maximum(at - k, 0)], np.uint64(0))

    two = back(1) | back(2) << np.uint64(9)
    three = two | back(3) << np.uint64(18)
    five = three | back(4) << np.uint64(27) | back(5) << np.uint64(36)
    power = np.cumprod(np.full(int(lengths.max()), _PRIME, dtype=np.uint64))
    terms = b * power[pos]
    before = np.cumsum(terms) - terms                   # polynomial hash of the word so far, mod 2^64
    prefix = before[at] - before[starts][own]
    slots = []
    for t, c in enumerate((two, three, five, prefix)):
        h = _mix(_mix(c + salt) + np.uint64((t + 1) * int(_PRIME) % (1 << 64)))
        slots.append((h >> np.uint64(64 - TABLE_BITS[t])).astype(np.int64))
    edge = np.empty(len(flat), dtype=np.int64)
    edge[order] = np.cumsum(by_place) - 1
    return Edges(flat[at].astype(np.int64), slots, word, edge)


def chunks(words: list[bytes], size: int = _CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of words of about ``size`` bytes."""
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    i = 0
    while i < len(words):
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield i, j
        i = j


def empty_tables() -> list[np.ndarray]:
    return [np.zeros((1 << bits, 2), dtype=np.float32) for bits in TABLE_BITS]


def add_words(tables: list[np.ndarray], words: list[bytes], classes: np.ndarray, counts: np.ndarray) -> None:
    for i, j in chunks(words):
        found = edges(words[i:j], classes[i:j])
        byte, n = found.byte, found.sums(counts[i:j]).astype(np.float32)
        for bit in range(8):
            node, one = 1 << bit | byte >> (8 - bit), byte >> (7 - bit) & 1
            for table, slot in zip(tables, found.slots):
                np.add.at(table.reshape(-1), (slot ^ node) * 2 + one, n)


# ---- mixing -----------------------------------------------------------------

_N_INPUTS = 6
_GATES = 8 * 4
_STEPS = 33                            # cells of the refinement per gate
_FIRST = np.array([0.1, 0.15, 0.2, 0.3, 0.3, 0.0])     # weights before anything is learned
_RIDGE = 100.0


class Mixer(NamedTuple):
    weights: np.ndarray                # (_GATES, _N_INPUTS)
    refine: np.ndarray                 # (8, _STEPS): share of ones
    met: np.ndarray                    # (_GATES,): bits learned from


def _level(n: np.ndarray) -> np.ndarray:
    return np.minimum(7, np.log2(n + 1).astype(np.int64))


def inputs(seen: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one by each predictor, and the gate."""
    two, three, five, word = seen

    def odds(n: np.ndarray, prior: float) -> np.ndarray:
        return np.log((n[:, 1] + prior) / (n[:, 0] + prior))

    x = np.stack([odds(two, 0.4), odds(three, 0.2), odds(five, 0.1), odds(word, 0.4), odds(word, 0.02),
                  np.full(len(two), 0.3, dtype=np.float32)]).astype(np.float32, copy=False).T
    gate = _level(word.sum(axis=1)) * 4 + np.minimum(3, _level(five.sum(axis=1)) // 2)
    return x, gate


def _cell(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2).astype(np.int64) + _STEPS // 2, 0, _STEPS - 1)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -14, 14)))


def planes(tables: list[np.ndarray]) -> list[np.ndarray]:
    """What ``inputs`` makes of every slot, made once: log odds and the share
    of the gate, packed so that one slot is one number to fetch."""
    out = []
    for t, table in enumerate(tables):
        priors = ((0.4,), (0.2,), (0.1,), (0.4, 0.02))[t]
        wide = np.zeros((len(table), 1 if t < 2 else 2 if t == 2 else 4), dtype=np.float16)
        for at in range(0, len(table), _BLOCK):
            n, block = table[at:at + _BLOCK].astype(np.float32), wide[at:at + _BLOCK]
            for i, p in enumerate(priors):
                block[:, i] = np.log((n[:, 1] + p) / (n[:, 0] + p))
            if t >= 2:
                seen = _level(n.sum(axis=1))
                block[:, len(priors)] = seen * 4 if t == 3 else np.minimum(3, seen // 2)
        out.append(wide.view({1: np.uint16, 2: np.uint32, 4: np.uint64}[wide.shape[1]]).ravel())
    return out


def _fetch(plane: np.ndarray, at: np.ndarray) -> np.ndarray:
    return plane.take(at).view(np.float16).reshape(len(at), -1).astype(np.float32)


def _seen(tables: list[np.ndarray], slots: list[np.ndarray], node: np.ndarray, one: np.ndarray) -> list[np.ndarray]:
    """The counts at the contexts of a byte's bits, without this very occurrence."""
    own, seen = np.stack([1 - one, one], axis=-1).reshape(-1, 2).astype(np.float32), []
    for t, s in zip(tables, slots):
        both = t.view(f"u{2 * t.itemsize}").ravel().take(s[:, None] ^ node).ravel()    # a slot is one number to fetch
        seen.append(np.maximum(0, both.view(t.dtype).astype(np.float32).reshape(-1, 2) - own))
    return seen


_BITS = np.arange(8)


class Bits(NamedTuple):
    """The bits of some words' bytes, those of a gate together."""
    x: np.ndarray                      # (_N_INPUTS, bits)
    gate: np.ndarray
    one: np.ndarray
    n: np.ndarray                      # how often each occurs

    def gates(self) -> Iterator[tuple[int, slice]]:
        ends = np.searchsorted(self.gate, np.arange(_GATES + 1))
        for g, (a, e) in enumerate(zip(ends[:-1], ends[1:])):
            if a < e:
                yield g, slice(a, e)


def bits(tables: list[np.ndarray], words: list[bytes], classes: np.ndarray, counts: np.ndarray, size: int) -> Iterator[Bits]:
    """The bits of about ``size`` bytes at once, also inside a longer word."""
    for i, j in chunks(words, size):
        found = edges(words[i:j], classes[i:j])
        n = found.sums(counts[i:j])
        for k in range(0, len(n), size):
            at = slice(k, k + size)
            byte = found.byte[at, None]
            node, one = 1 << _BITS | byte >> (8 - _BITS), byte >> (7 - _BITS) & 1
            x, gate = inputs(_seen(tables, [s[at] for s in found.slots], node, one))
            gate = gate.astype(np.uint8)
            order = np.argsort(gate, kind="stable")
            yield Bits(np.stack([row.take(order) for row in x.T]), gate[order], one.ravel()[order], np.repeat(n[at], 8)[order])


def _bend(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return (x * by) @ x.T


def _prior() -> tuple[np.ndarray, np.ndarray]:
    """Ones and all by the refinement's cells before anything is seen."""
    total = np.full((8, _STEPS), 2.0)
    return _squash((np.arange(_STEPS) - _STEPS // 2) / 2) * total, total


def train_mixer(tables: list[np.ndarray], words: list[bytes], classes: np.ndarray, counts: np.ndarray | None = None) -> Mixer:
    """One online pass over the words, each ``counts`` times (or once): a gate's
    weights fit the bits at hand, held to what it had before by the curvature of
    all bits before; and the refinement on what they say."""
    counts = np.ones(len(words)) if counts is None else counts
    weights, met, (hits, total) = np.tile(_FIRST, (_GATES, 1)), np.zeros(_GATES), _prior()
    bend = np.tile(np.eye(_N_INPUTS) * _RIDGE, (_GATES, 1, 1))
    for some in bits(tables, words, classes, counts, _SCORED):
        for g, at in some.gates():
            x, one, n, w = some.x[:, at].astype(np.float64), some.one[at], some.n[at], weights[g].copy()
            for _ in range(_ONLINE_STEPS):
                p = _squash(w @ x)
                curve = bend[g] + _bend(x, n * p * (1 - p))
                move = np.clip(np.linalg.solve(curve, x @ (n * (one - p)) - bend[g] @ (w - weights[g])), -1, 1)
                w += move
                if np.abs(move).max() < 0.01:
                    break
            weights[g], bend[g] = w, curve
            met[g] += n.sum()
            cell = _cell(w @ x)
            hits[g // 4] += np.bincount(cell, n * one, _STEPS)
            total[g // 4] += np.bincount(cell, n, _STEPS)
    return Mixer(weights.astype(np.float32), (hits / total).astype(np.float32), met)


_PAIRS = [(k, m) for k in range(_N_INPUTS) for m in range(k, _N_INPUTS)]
_UPPER = np.triu_indices(_N_INPUTS)    # the same pairs, as places of a matrix
_STAT_SHAPES = [(_N_INPUTS, _GATES), (len(_PAIRS), _GATES), (8, _STEPS), (8, _STEPS), (2, _GATES)]
_STATS = sum(a * b for a, b in _STAT_SHAPES)


def mixer_stats(tables: list[np.ndarray], weights: np.ndarray, words: list[bytes], classes: np.ndarray,
                counts: np.ndarray) -> np.ndarray:
    """Of the words, each ``counts`` times: gradient and curvature of the log
    likelihood by gate, ones and all by the refinement's cells, bits and their
    loss by gate; laid end to end."""
    slope, curve, hits, total, (met, loss) = (np.zeros(shape) for shape in _STAT_SHAPES)
    for some in bits(tables, words, classes, counts, _SCORED // 4):
        one, n = some.one, some.n
        z = np.empty(len(n), dtype=np.float32)
        for g, at in some.gates():
            z[at] = weights[g].astype(np.float32) @ some.x[:, at]
        p = _squash(z)
        off, bend = n * (one - p), n * p * (1 - p)
        for g, at in some.gates():
            x = some.x[:, at].astype(np.float64)
            slope[:, g] += x @ off[at]
            curve[:, g] += _bend(x, bend[at])[_UPPER]
        cell = (some.gate >> 2).astype(np.int64) * _STEPS + _cell(z)
        hits += np.bincount(cell, n * one, 8 * _STEPS).reshape(8, _STEPS)
        total += np.bincount(cell, n, 8 * _STEPS).reshape(8, _STEPS)
        met += np.bincount(some.gate, n, _GATES)
        loss -= np.bincount(some.gate, n * np.log(np.where(one == 1, p, 1 - p)), _GATES)
    return np.concatenate([a.ravel() for a in (slope, curve, hits, total, met, loss)])


def _apart(stats: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum([a * b for a, b in _STAT_SHAPES])
    return [a.reshape(shape) for a, shape in zip(np.split(stats, ends[:-1]), _STAT_SHAPES)]


def _loss(weights: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """What the fit makes least, by gate: the bits' loss, and ``_RIDGE`` holds gates of few bits at the first weights."""
    return _apart(stats)[-1][1] + _RIDGE / 2 * ((weights - _FIRST) ** 2).sum(axis=1)


def newton_step(weights: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A Newton step, and what it should save by gate."""
    slope, curve = _apart(stats)[:2]
    bend = np.tile(np.eye(_N_INPUTS) * _RIDGE, (_GATES, 1, 1))
    for at, (k, m) in enumerate(_PAIRS):
        bend[:, k, m] += curve[at]
        if k != m:
            bend[:, m, k] += curve[at]
    slope = slope.T - _RIDGE * (weights - _FIRST)
    step = np.clip(np.linalg.solve(bend, slope[:, :, None])[:, :, 0], -1, 1)
    return step, (step * slope).sum(axis=1) / 2


def newton(weights: np.ndarray, stats: np.ndarray, step: np.ndarray | None = None) -> Mixer:
    """The weights a step further, a Newton step unless another is given, and the refinement."""
    _, _, hits, total, (met, _) = _apart(stats)
    ones, seen = _prior()
    moved = weights + (newton_step(weights, stats)[0] if step is None else step)
    return Mixer(moved.astype(np.float32), ((hits + ones) / (total + seen)).astype(np.float32), met)


def word_scores(made: list[np.ndarray], mixer: Mixer, words: list[bytes], classes: np.ndarray) -> np.ndarray:
    """log10 probability of each word given its class; ``made`` by ``planes``."""
    out = np.zeros(len(words))
    weights, refine = np.ascontiguousarray(mixer.weights.T), mixer.refine.ravel()
    for i, j in chunks(words, _SCORED):
        found = edges(words[i:j], classes[i:j])
        byte = found.byte
        total = np.ones(len(byte))                             # probability of the byte, eight bits
        for bit in range(8):
            node, one = 1 << bit | byte >> (8 - bit), byte >> (7 - bit) & 1
            two, three, five, whole = (_fetch(p, s ^ node) for p, s in zip(made, found.slots))
            gate = (whole[:, 2] + five[:, 1]).astype(np.int64)
            z = weights[5].take(gate) * np.float32(0.3)
            for k, x in enumerate((two[:, 0], three[:, 0], five[:, 0], whole[:, 0], whole[:, 1])):
                z += weights[k].take(gate) * x
            p = 0.75 * _squash(z) + 0.25 * refine.take((gate >> 2) * _STEPS + _cell(z))
            p = np.clip(p, 1e-6, 1 - 1e-6)
            total *= np.where(one == 1, p, 1 - p)
        out[i:j] = np.bincount(found.word, np.log10(total)[found.edge], j - i)
    return out


# ---- classes ----------------------------------------------------------------

def profile(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint16)
    v = np.sqrt(np.bincount(raw[:-1] * np.uint16(67) + raw[1:] * np.uint16(5) & np.uint16(_PROFILE - 1), minlength=_PROFILE)) \
        if len(raw) > 1 else np.zeros(_PROFILE)
    return (v / max(1e-9, np.linalg.norm(v))).astype(np.float32)


def fit_classes(x: np.ndarray, k: int = CLASSES, rounds: int = 15, starts: int = 12) -> np.ndarray:
    """Centres of spherical k-means, the best of some random starts (fixed seed)."""
    best, found = -1.0, np.zeros((k, _PROFILE), dtype=np.float32)
    if not len(x):
        return found
    rng = np.random.default_rng(2)
    for _ in range(starts):
        centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
        for _ in range(rounds):
            own = (x @ centres.T).argmax(axis=1)
            for i in range(k):
                if (own == i).any():
                    c = x[own == i].sum(axis=0)
                    centres[i] = c / max(1e-9, np.linalg.norm(c))
        fit = float((x @ centres.T).max(axis=1).sum())
        if fit > best:
            best, found = fit, centres
    return found


# ---- Spark ------------------------------------------------------------------

def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       held_out().alias("held_out"))


def _sample(rows: DataFrame) -> np.ndarray:
    """Profiles of a bounded sample of rows: where the rounds over all rows begin."""
    chosen = (rows.where("not held_out").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
              .limit(CLASS_ROWS).distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "profile": [profile(t.encode("utf-8").lower()).tobytes() for t in b["text"]]})

    joined = rows.where("not held_out").join(F.broadcast(chosen), "doc_id")     # at most CLASS_ROWS ids
    found = (joined.select("text", F.xxhash64("doc_id", "text").alias("h"))
             .mapInPandas(run, "h long, profile binary").orderBy("h").limit(CLASS_ROWS).collect())
    return np.array([np.frombuffer(r["profile"], dtype=np.float32) for r in found]).reshape(-1, _PROFILE)


_SUMS_SCHEMA = "at int, block binary"


def _laid(sums: np.ndarray) -> pd.DataFrame:
    """A task's sums in blocks, few rows each."""
    at = range(0, len(sums), _SUMS)
    return pd.DataFrame({"at": list(at), "block": [sums[i:i + _SUMS].tobytes() for i in at]})


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The tasks' sums added up by place, each block on its own."""

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(raw, dtype=np.float64) for raw in group["block"])
        return pd.DataFrame({"at": [key[0]], "block": [total.tobytes()]})

    out = np.zeros(size)
    for r in parts.groupBy("at").applyInPandas(add, _SUMS_SCHEMA).collect():
        block = np.frombuffer(r["block"], dtype=np.float64)
        out[r["at"]:r["at"] + len(block)] = block
    return out


def refine_classes(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """A round of spherical k-means over all training rows; a class without rows keeps its centre."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, old = np.zeros((CLASSES, _PROFILE)), shared.value
        for b in batches:
            for t in b["text"]:
                x = profile(t.encode("utf-8").lower())
                sums[int((old @ x).argmax())] += x
        yield _laid(sums.ravel())

    sums = _summed(rows.where("not held_out").select("text").mapInPandas(run, _SUMS_SCHEMA),
                   CLASSES * _PROFILE).reshape(CLASSES, _PROFILE)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(norm > 0, sums / np.maximum(norm, 1e-9), centres).astype(np.float32)


def _dealt(counts: DataFrame, tasks: int) -> DataFrame:
    """(class, word) rows in order, dealt by ranges: words that begin alike meet."""
    return counts.repartitionByRange(max(1, tasks), "class", "word").sortWithinPartitions("class", "word")


def fit_mixer(counts: DataFrame, n_rows: int, tables: list[np.ndarray], start: Mixer | None = None,
              least: float = np.inf) -> Mixer:
    """Weights and refinement on all (class, word) rows with their counts: Newton
    steps from ``start``, or else from the mean of an online pass in each batch
    of rows, until one should save no more than the share ``least`` of the loss;
    that one is the last. A gate whose loss has grown goes back half its step."""
    # Every round reads the rows, so they are dealt once.
    dealt = materialize(_dealt(counts, -(-n_rows // MIX_TASK)), "lm-dealt")
    shared = counts.sparkSession.sparkContext.broadcast(tables)

    def over_all(of: Callable[..., np.ndarray], size: int) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(size)
            for b in batches:
                sums += of(shared.value, b["word"].tolist(), b["class"].to_numpy(), b["n"].to_numpy())
            yield _laid(sums)

        return _summed(dealt.mapInPandas(run, _SUMS_SCHEMA), size)

    def online(*rows) -> np.ndarray:
        mixer = train_mixer(*rows)
        return np.append(mixer.weights.T * mixer.met, mixer.met)

    if start is None:
        sums = over_all(online, (_N_INPUTS + 1) * _GATES).reshape(-1, _GATES)
        weights = np.where(sums[-1] > 0, sums[:-1] / np.maximum(1, sums[-1]), _FIRST[:, None]).T
    else:
        weights = start.weights.astype(np.float64)
    step, loss, saved = np.zeros_like(weights), np.full(_GATES, np.inf), np.zeros(_GATES)
    while True:
        at = (weights + step).astype(np.float32)
        stats = over_all(lambda t, *rows, at=at: mixer_stats(t, at, *rows), _STATS)
        (move, save), now = newton_step(at, stats), _loss(at, stats)
        back = now > loss
        weights = np.where(back[:, None], weights, weights + step)
        step, saved = np.where(back[:, None], step / 2, move), np.where(back, saved / 2, save)
        loss = np.where(back, loss, now)
        if not saved.sum() > least * loss.sum():
            shared.destroy()
            return newton(weights, stats, step)


def classify(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """The rows with their class. It is written once: words are counted and looked up by the same."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([int((shared.value @ profile(t.encode("utf-8").lower())).argmax()) for t in texts], dtype="int32")

    return rows.withColumn("class", F.pandas_udf(run, "int")("text"))


def count_words(rows: DataFrame) -> DataFrame:
    """(class, word, n, total, first) over all rows: ``n`` counts the training
    rows of the class, ``total`` those of all classes, and one row of each word
    is its ``first``; the end token is a word too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [Counter() for _ in range(CLASSES)]

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"class": np.repeat(np.arange(CLASSES, dtype=np.int32), [len(c) for c in counts]),
                                "word": [w for c in counts for w in c],
                                "n": [n for c in counts for n in c.values()]})
            for c in counts:
                c.clear()
            return out.astype({"n": "int64"})

        for b in batches:
            for t, z, held in zip(b["text"], b["class"].tolist(), b["held_out"].tolist()):
                words = t.encode("utf-8").lower().split()
                words.append(END)
                counts[z].update(dict.fromkeys(words, 0) if held else words)
                if sum(map(len, counts)) > _FLUSH:
                    yield flush()
        yield flush()

    by_word = Window.partitionBy("word")
    return (rows.select("text", "class", "held_out").mapInPandas(run, "class int, word binary, n long")
            .repartition("word").groupBy("class", "word").agg(F.sum("n").alias("n"))
            .select("class", "word", "n", F.sum("n").over(by_word).alias("total"),
                    (F.min("class").over(by_word) == F.col("class")).alias("first")))


def score_words(counts: DataFrame, n_rows: int, made: list[np.ndarray], mixer: Mixer) -> DataFrame:
    """(class, word, n, total, score): every row of the counts scored once."""
    shared = counts.sparkSession.sparkContext.broadcast((made, mixer))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(score=word_scores(*shared.value, b["word"].tolist(), b["class"].to_numpy()))

    return (_dealt(counts.select("class", "word", "n", "total"), -(-n_rows // MIX_TASK))
            .mapInPandas(run, "class int, word binary, n long, total long, score double"))


def count_contexts(counts: DataFrame, n_rows: int) -> list[np.ndarray]:
    """The context tables in half precision, summed over all (class, word) rows."""
    tasks = max(1, -(-n_rows // WORDS_PER_TABLE))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, part = empty_tables(), TaskContext.get().partitionId()
        for b in batches:
            add_words(tables, b["word"].tolist(), b["class"].to_numpy(), b["n"].to_numpy())
        for t, table in enumerate(tables):
            for at in range(0, len(table), _BLOCK):
                block = table[at:at + _BLOCK]
                if block.any():
                    yield pd.DataFrame({"t": [t], "at": [at], "part": [part], "block": [block.tobytes()]})

    def summed(blocks) -> np.ndarray:
        total = np.zeros((_BLOCK, 2), dtype=np.float64)
        for raw in blocks:
            block = np.frombuffer(raw, dtype=np.float32).reshape(-1, 2)
            total[:len(block)] += block
        return total

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        block = summed(group["block"]).astype(np.float32).tobytes()
        return pd.DataFrame({"t": [key[0]], "at": [key[1]], "part": [key[2]], "block": [block]})

    def finish(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = summed(group["block"])
        total *= np.minimum(1.0, 60_000 / np.maximum(1, total.max(axis=1, keepdims=True)))    # half precision's range
        return pd.DataFrame({"t": [key[0]], "at": [key[1]], "block": [total.astype(np.float16).tobytes()]})

    schema = "t int, at int, part int, block binary"
    blocks = _dealt(counts, tasks).mapInPandas(fill, schema)
    while tasks > _PARTS:              # so that no task holds more than that many blocks
        tasks = -(-tasks // _PARTS)
        blocks = blocks.groupBy("t", "at", F.pmod("part", F.lit(tasks)).alias("part")).applyInPandas(add, schema)
    blocks = blocks.groupBy("t", "at").applyInPandas(finish, "t int, at int, block binary").collect()
    tables = [np.zeros((1 << bits, 2), dtype=np.float16) for bits in TABLE_BITS]
    for r in blocks:
        part = np.frombuffer(r["block"], dtype=np.float16).reshape(-1, 2)
        tables[r["t"]][r["at"]:r["at"] + _BLOCK] = part
    return tables


def top_words(words: DataFrame, most: int = TOP_WORDS) -> dict[tuple[int, bytes], tuple[float, int]]:
    """The commonest (class, word) rows with their scores and totals, at most
    ``most`` of them: all rows above a level of count that few enough reach."""
    level = F.floor(F.log2("n") * 4)
    words = words.where("n > 0")
    per = sorted(words.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    total, least = 0, None
    for r in per:
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    if least is None:
        return {}
    return {(r["class"], bytes(r["word"])): (r["score"], r["total"]) for r in words.where(level >= least).collect()}


class Lookup:
    """What the tasks need: the commonest words' numbers by class, and by number
    the score and the base score's share; number -1 is of the others."""

    def __init__(self, top: dict[tuple[int, bytes], tuple[float, int]]):
        self.number: list[dict[bytes, int]] = [{} for _ in range(CLASSES)]
        for i, (z, w) in enumerate(top):
            self.number[z][w] = i
        self.score = np.array([s for s, _ in top.values()] + [0.0])
        self.known = np.array([np.log10(n + 1) for _, n in top.values()] + [0.0])


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    bits_per_byte of every row."""
    rows, spark = _texts(docs), docs.sparkSession
    centres = fit_classes(_sample(rows))
    for _ in range(CLASS_ROUNDS):
        centres = refine_classes(rows, centres)
    # Written once, so the row numbers hold for both sides of the last join.
    texts = materialize(classify(rows, centres).withColumn("row", F.monotonically_increasing_id()), "lm-texts")
    counts = materialize(count_words(texts), "lm-counts")
    facts = counts.agg(F.count_if(F.col("first") & (F.col("total") > 0)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.count_if(F.col("n") > 0).alias("seen"), F.count(F.lit(1)).alias("rows")).first()
    training = counts.where("n > 0").select("class", "word", "n")
    tables = count_contexts(training, facts["seen"])
    mixer = fit_mixer(training, facts["seen"], tables, least=SETTLED)
    made = planes(tables)
    del tables
    scores = materialize(score_words(counts, facts["rows"], made, mixer), "lm-scores")
    del made
    shared = spark.sparkContext.broadcast(Lookup(top_words(scores)))
    lowest = float(np.log10(facts["n"] + facts["v"] + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = shared.value
        for b in (whole.iloc[i:i + _SLICE] for whole in batches for i in range(0, len(whole), _SLICE)):
            raws = [t.encode("utf-8").lower() for t in b["text"]]
            tokens = [[*raw.split(), END] for raw in raws]
            n_all = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
            starts = np.cumsum(n_all) - n_all
            number = np.fromiter(chain.from_iterable(map(top.number[z].get, own, repeat(-1)) for z, own in zip(b["class"], tokens)),
                                 dtype=np.int64, count=int(n_all.sum()))
            found = number >= 0
            rare: list[Counter] = [Counter() for _ in tokens]
            missed = np.flatnonzero(~found)
            doc = np.searchsorted(starts, missed, side="right") - 1
            for d, at in zip(doc.tolist(), (missed - starts[doc]).tolist()):
                rare[d][tokens[d][at]] += 1
            base = np.add.reduceat(top.known[number], starts) - lowest * n_all
            yield b.drop(columns="text").assign(
                n_tokens=n_all, known=np.add.reduceat(found.astype(np.int64), starts), base=base,
                score=np.add.reduceat(top.score[number], starts) - np.log10(CLASSES), n_bytes=list(map(len, raws)),
                rare=[list(c) for c in rare], times=[list(c.values()) for c in rare])

    # The id goes as text: pandas would make a float of a long beside a NULL.
    scored = texts.select("row", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "class", "text").mapInPandas(
        run, "row long, doc_id string, held_out boolean, class int, n_tokens long, known long, base double, "
             "score double, n_bytes long, rare array<binary>, times array<long>")
    scored = materialize(scored, "lm-scored")
    rare = (scored.select("row", "class", F.explode(F.arrays_zip("rare", "times")).alias("t"))
            .select("row", "class", F.col("t.rare").alias("word"), F.col("t.times").alias("times")))
    found = (rare.join(scores.select("class", "word", "total", F.col("score").alias("each")), ["class", "word"]).groupBy("row")
             .agg(F.sum(F.when(F.col("total") > 0, F.col("times"))).alias("more"),
                  F.sum(F.col("times") * F.log10(F.col("total") + 1)).alias("plus"),
                  F.sum(F.col("times") * F.col("each")).alias("rest")))
    score = F.col("score") + F.coalesce("rest", F.lit(0.0))
    bits = -F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))
    return (scored.drop("rare", "times", "class").join(found, "row", "left")
            .withColumn("score", score)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens",
                    (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(int(facts["n"])).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("plus", F.lit(0.0))).alias("base_score"),
                    "score", bits.alias("bits_per_byte")))

"""Periodic runs of a text's words, found in its Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q, at least
``times`` periods and ``least`` words long, that no neighbour extends.

Method, per text:

1. Every word of a run occurs in it ``times`` times, and every pair of
   neighbours once less. Words and pairs that the text holds less often cut it,
   again and again until nothing changes; pieces shorter than a run are left
   out. Prose has nothing left here. (These are the pairs that Re-Pair would
   not replace; no run crosses one.)
2. Re-Pair over the pieces: the most frequent pair of neighbours becomes a
   nonterminal until no pair repeats. What remains of a piece is the bottom of a
   balanced tree whose nodes derive one place each.
3. A run belongs to the one node whose border it crosses, and on one side of it
   holds two periods. Per node the periods are sought once: squares that begin
   or end at the border, the shortest first; a square that an earlier period
   already covers can't be primitive, so only a few are left. Common extensions
   are compared as bytes.
4. Runs of a nonterminal are moved to all places that it derives. A run cut off
   by the end of a node is also found, longer, at a node above: of the intervals
   of one period only the maximal ones stay.

A text is one row's work: memory and time grow with the text, not with the
table; rows are independent (no shuffle).

Defined cases: NULL and empty texts have no words and no runs; every row gives
a row, repeated ones too; NULL doc_id stays NULL; an empty table gives no rows;
columns besides doc_id and text are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of

LEAST = 6           # words of a run
TIMES = 4           # its periods
_WIDTH = 4          # bytes of a word's number
_RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def pieces(ids: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Stretches of words that can hold runs."""
    if len(ids) < least:
        return []
    often = np.bincount(ids)[ids] >= times
    alive = _long_ones(often[:-1] & often[1:], least - 1)           # of pairs (i, i + 1)
    wide = int(ids.max()) + 1
    while len(at := alive.nonzero()[0]):
        _, place, n = np.unique(ids[at] * wide + ids[at + 1], return_inverse=True, return_counts=True)
        rare = n[place] < times - 1
        if not rare.any():
            break
        alive[at[rare]] = False
        alive = _long_ones(alive, least - 1)
    edges = np.diff(np.concatenate([[0], alive.astype(np.int8), [0]]))
    return list(zip((edges == 1).nonzero()[0].tolist(), ((edges == -1).nonzero()[0] + 1).tolist()))


def _long_ones(alive: np.ndarray, least: int) -> np.ndarray:
    """Without the stretches that are shorter than ``least``."""
    edges = np.diff(np.concatenate([[0], alive.astype(np.int8), [0]]))
    starts, ends = (edges == 1).nonzero()[0], (edges == -1).nonzero()[0]
    keep = ends - starts >= least
    marks = np.zeros(len(alive) + 1, dtype=np.int64)
    marks[starts[keep]] += 1
    marks[ends[keep]] -= 1
    return marks[:-1].cumsum() > 0


class Grammar:
    """Re-Pair over pieces of a text. Symbols below ``base`` are words; rule k is
    the symbol ``base + k``, with its two parts, its length and one place."""

    def __init__(self, ids: list[int], spans: list[tuple[int, int]]):
        self.base = max(ids, default=-1) + 1
        self.rules: list[tuple[int, int]] = []
        self.lengths: list[int] = []
        self.places: list[int] = []
        self.symbol, self.place, self.after, self.before = [], [], [], []
        self.firsts = []
        for s, e in spans:
            self.firsts.append(len(self.symbol))
            here = range(len(self.symbol), len(self.symbol) + e - s)
            self.symbol += ids[s:e]
            self.place += range(s, e)
            self.after += [*here[1:], -1]
            self.before += [-1, *here[:-1]]
        self._replace_all()

    def length(self, symbol: int) -> int:
        return self.lengths[symbol - self.base] if symbol >= self.base else 1

    def _replace_all(self) -> None:
        symbol, after, before = self.symbol, self.after, self.before
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, j in enumerate(after):
            if j >= 0:
                found[symbol[i], symbol[j]].add(i)
        heap = [(-len(at), pair) for pair, at in found.items() if len(at) > 1]
        heapq.heapify(heap)
        while heap:
            n, pair = heapq.heappop(heap)
            now = len(found.get(pair, ()))
            if now < 2:
                continue
            if now != -n:                       # fewer since it was put there
                heapq.heappush(heap, (-now, pair))
                continue
            a, b = pair
            new, touched, place = self.base + len(self.rules), set(), -1
            for i in sorted(found.pop(pair)):
                j = after[i]
                if symbol[i] != a or j < 0 or symbol[j] != b:
                    continue                    # overlaps the place before
                if place < 0:
                    place = self.place[i]
                left, right = before[i], after[j]
                if left >= 0:
                    if (gone := (symbol[left], a)) in found:
                        found[gone].discard(left)
                    found[symbol[left], new].add(left)
                    touched.add((symbol[left], new))
                if right >= 0:
                    if (gone := (b, symbol[right])) in found:
                        found[gone].discard(j)
                    found[new, symbol[right]].add(i)
                    touched.add((new, symbol[right]))
                    before[right] = i
                symbol[i], symbol[j], after[i] = new, -1, right
            self.rules.append(pair)
            self.lengths.append(self.length(a) + self.length(b))
            self.places.append(place)
            for pair in touched:
                if len(found[pair]) > 1:
                    heapq.heappush(heap, (-len(found[pair]), pair))

    def remains(self) -> Iterator[tuple[list[int], list[int]]]:
        """Symbols left of each piece and their places."""
        for i in self.firsts:
            symbols, places = [], []
            while i >= 0:
                symbols.append(self.symbol[i])
                places.append(self.place[i])
                i = self.after[i]
            yield symbols, places


def _common(data: bytes, i: int, j: int, most: int) -> int:
    """Length of the common prefix at words i and j, at most ``most``."""
    done, step = 0, 4
    while done < most:
        step = min(step, most - done)
        x, y = _WIDTH * (i + done), _WIDTH * (j + done)
        if data[x:x + _WIDTH * step] == data[y:y + _WIDTH * step]:
            done += step
            step *= 2
            continue
        while step > 1:
            half = step // 2
            x, y = _WIDTH * (i + done), _WIDTH * (j + done)
            if data[x:x + _WIDTH * half] == data[y:y + _WIDTH * half]:
                done += half
                step -= half
            else:
                step = half
        return done
    return done


def _squares(data: bytes, at: int, end: int, most: int) -> Iterator[tuple[int, int]]:
    """(p, common extension at distance p) of the primitive squares of period p
    <= ``most`` that begin at word ``at`` and end by ``end``, the shortest first."""
    most = min(most, (end - at) // 2)
    if most < 1:
        return
    p = 2
    if data[_WIDTH * at:_WIDTH * (at + 1)] == data[_WIDTH * (at + 1):_WIDTH * (at + 2)]:
        n = _common(data, at, at + 1, end - at - 1)
        yield 1, n
        p = (1 + n) // 2 + 1
    pair = data[_WIDTH * at:_WIDTH * (at + 2)]
    x, last = _WIDTH * (at + p), min(_WIDTH * (at + most + 2), _WIDTH * end)
    while (x := data.find(pair, x, last)) >= 0:
        if x % _WIDTH:
            x += 1
            continue
        p = x // _WIDTH - at
        n = _common(data, at, at + p, end - at - p)
        if n >= p:
            yield p, n
            x = _WIDTH * (at + (p + n) // 2 + 1)        # shorter ones repeat this period
        else:
            x += _WIDTH


class RunFinder:
    def __init__(self, ids: np.ndarray, least: int = LEAST, times: int = TIMES):
        if times < 4:
            raise ValueError("a run must hold at least 4 periods")
        self.least, self.times = least, times
        self.spans = pieces(ids, least, times)
        if self.spans:
            self.ids, self.n = ids.tolist(), len(ids)
            self.text = ids.astype("<u4").tobytes()
            self.back = ids[::-1].astype("<u4").tobytes()

    def crossing(self, start: int, border: int, end: int) -> set[tuple[int, int, int]]:
        """(period, start, end) of the runs of ``start:end`` that hold words on
        both sides of the border."""
        out, n = set(), self.n
        most = (end - start) // self.times
        if end - start < self.least:
            return out
        for p, more in _squares(self.text, border, end, most):
            left = _common(self.back, n - border, n - border - p, border - start)
            if left and left + p + more >= max(self.least, self.times * p):
                out.add((p, border - left, border + p + more))
        for p, more in _squares(self.back, n - border, n - start, most):
            right = _common(self.text, border, border - p, end - border)
            if right and right + p + more >= max(self.least, self.times * p):
                out.add((p, border - p - more, border + right))
        return out

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs by start, then period."""
        if not self.spans:
            return []
        g = Grammar(self.ids, self.spans)
        found: list[tuple[int, int, int]] = []
        places: dict[int, list[int]] = defaultdict(list)
        for symbols, starts in g.remains():
            for symbol, place in zip(symbols, starts):
                if symbol >= g.base:
                    places[symbol - g.base].append(place)
            ends = [*starts[1:], starts[-1] + g.length(symbols[-1])]
            nodes = [(0, len(symbols))]
            while nodes:
                i, j = nodes.pop()
                if j - i > 1:
                    half = (i + j) // 2
                    found += self.crossing(starts[i], starts[half], ends[j - 1])
                    nodes += [(i, half), (half, j)]
        own = [self.crossing(place, place + g.length(rule[0]), place + length)
               for rule, length, place in zip(g.rules, g.lengths, g.places)]
        holds = []                                  # it or a rule below it has runs
        for rule, runs in zip(g.rules, own):
            holds.append(bool(runs) or any(x >= g.base and holds[x - g.base] for x in rule))
        for k in range(len(g.rules) - 1, -1, -1):
            if not holds[k]:
                continue
            at = places.pop(k, [])
            found += [(p, s - g.places[k] + x, e - g.places[k] + x) for p, s, e in own[k] for x in at]
            a, b = g.rules[k]
            if a >= g.base and holds[a - g.base]:
                places[a - g.base] += at
            if b >= g.base and holds[b - g.base]:
                more = g.length(a)
                places[b - g.base] += [x + more for x in at]
        out, period, until = [], 0, 0
        for p, s, e in sorted(set(found), key=lambda r: (r[0], r[1], -r[2])):
            if p != period or e > until:
                out.append((s, e - s, p))
                period, until = p, e
        return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words."""
    number: dict = defaultdict()
    number.default_factory = number.__len__
    return RunFinder(np.fromiter(map(number.__getitem__, words), np.int64, len(words)), least, times).runs()


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in keep.nonzero()[0].tolist()]


def repeat_tail(doc_id: int | None, words: list) -> list:
    """The words with, for one in ten ids by checksum, a tail that repeats its
    own beginning: test material whose runs are known to be there."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES,
              change: Callable[[int | None, list], list] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and
    the collapsed text of every row. ``change`` may replace a text's words first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            ids = b["doc_id"].astype("Int64")
            for doc, text in zip(ids.tolist(), b["text"]):
                words = text.encode().split()           # at ASCII blanks
                if change:
                    words = change(None if doc is pd.NA else doc, words)
                runs = runs_of(words, least, times)
                out.append((len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs],
                            b" ".join(collapse(words, runs)).decode()))
            frame = pd.DataFrame(out, columns=["n_words", "runs", "collapsed"])
            frame.insert(0, "doc_id", ids.array)
            yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(run, _RUNS)


def _greatest(runs: Column) -> Column:
    """The run of the greatest exact length / period, the first of equal ones."""
    return F.reduce(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"),
                    lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r)
                    .otherwise(best))


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the greatest
    run; digests of all runs and of the collapsed text. Tails are repeated first."""
    found = find_runs(docs, change=repeat_tail)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                r["period"].cast("string")), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), _greatest(F.col("runs")).alias("best"),
                        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")

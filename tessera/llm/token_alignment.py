"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

A text is encoded twice: space + text by a byte-level BPE (A), and the text by
a BPE of pieces that puts a space before it (B). Byte offsets where tokens of
both end cut the tokens into groups; two tokens are linked if their byte ranges
overlap. A link's count is how often its id pair is linked in the corpus.

Method: an array maps every A id to the B id with the same bytes. A group of
one A token and the B token of that array is *regular*: it is kept as its A id
only and counted in a vector as long as A's vocabulary. Only links of other
groups enter the shuffle that counts pairs, summed by each task before it.

Whether a text's links are the best of their B ids is known once the corpus is
counted, so documents are scored in a second pass over their written ids:
regular groups by the vector, links of the ``frequent`` most counted pairs by a
table of that many rows (both bounded, broadcast), and the links of all other
pairs by a join on the pair. So no pair, however common, meets in one task.

Encoding: no token of either tokenizer joins a non-blank to white space after
it (but for U+000D, which B's pieces may end with; B's vocabulary is checked
for this when it is loaded). Texts are cut there and a worker encodes each distinct
segment once, until it holds ``SEGMENTS`` of them or ``TOKENS`` ids; memory of a
task depends on these bounds and on its longest text. Tests hold this to whole-text encoding.

Defined cases: texts that are NULL or empty, or that a tokenizer doesn't give
back byte for byte, have no tokens: zeros, and the empty text for the groups.
Every row gives a row, repeated ones too (each counts); NULL doc_id stays NULL;
special strings are plain text; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, text_of

SEGMENTS = 400_000          # distinct segments kept by a worker, then started anew
TOKENS = 6_000_000          # ids of kept segments, likewise
SLICE = 1 << 20             # characters encoded at once
FREQUENT = 1 << 17          # pairs scored by broadcast
DISTINCT = 1 << 21          # pairs summed inside a task before they are handed on
_CUT = re.compile(r"(?<=\S)(?=[^\S\r])")

_LINKS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
          "regular binary, linked_a binary, linked_b binary")


def _byte_level() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    char = {chr(b): b for b in shown}
    return char | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


class Tokenizers:
    """Both tokenizers: ids, byte lengths and the map of ids with equal bytes."""

    _made: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        char = _byte_level()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in char for c in token):
                self.a_bytes[i] = bytes(map(char.__getitem__, token))
        self.b_bytes, normal = [], []
        for i in range(self.b.get_piece_size()):
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(self.b.id_to_piece(i)[1:-1], 16)]))
            else:
                control = self.b.is_control(i) or self.b.is_unknown(i)
                self.b_bytes.append(b"" if control else self.b.id_to_piece(i).replace("▁", " ").encode())
                normal.append(i)
        same = {x: i for i, x in enumerate(self.b_bytes) if x}
        same |= {self.b_bytes[i]: i for i in reversed(normal) if self.b_bytes[i]}
        self.same = np.array([same.get(x, -1) if x else -1 for x in self.a_bytes], dtype=np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.blank = self.b.piece_to_id("▁")
        self.marked = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
        self.marked += [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"]
        # Segments are independent if no piece joins a non-blank to white space, or its own space to other white space.
        pieces = [x.decode("utf-8", "replace") for i in normal for x in [self.b_bytes[i]]]
        self.cuts = not any(re.search(r"\S[^\S\r]|^ +[^\S\r ]", p) for p in pieces)

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Tokenizers:
        if (a_path, b_path) not in cls._made:
            cls._made[a_path, b_path] = cls(a_path, b_path)
        return cls._made[a_path, b_path]

    def segments(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.cuts else [" " + text]

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of the segments as they are inside a text."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        spaced = [s[0] == " " for s in segments]
        b = self.b.encode([s[1:] if x else s for s, x in zip(segments, spaced)], num_threads=1)
        # The library's own space is the segment's, or must go where there is none.
        return a, [ids if x and len(s) > 1 else [self.blank] if x else ids[1:]
                   for s, x, ids in zip(segments, spaced, b)]


class SegmentTable:
    """Alignments of distinct segments; ``gather`` reads many at once."""

    _made: dict[tuple[str, str], SegmentTable] = {}

    @classmethod
    def of(cls, a_path: str, b_path: str) -> SegmentTable:
        """The table that the tasks of a worker share."""
        if (a_path, b_path) not in cls._made:
            cls._made[a_path, b_path] = cls(Tokenizers.of(a_path, b_path))
        return cls._made[a_path, b_path]

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)          # A tokens, B tokens, groups; 1 if given back
        self.regular = (np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32))
        self.links = (np.zeros(1, dtype=np.int64), np.zeros((0, 2), dtype=np.int32))

    def look_up(self, segments: list[str]) -> np.ndarray:
        """Places of the segments; encodes those that are new."""
        if len(self.index) > SEGMENTS or len(self.regular[1]) + len(self.links[1]) > TOKENS:
            self.clear()
        new = [s for s in dict.fromkeys(segments) if s not in self.index]
        if new:
            self.index.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
            self._add(new)
        return np.fromiter(map(self.index.__getitem__, segments), np.int64, len(segments))

    def _add(self, new: list[str]) -> None:
        t = self.t
        a, b = t.encode(new)
        good = np.ones(len(new), dtype=bool)
        if any(b"".join([said[i] for x in ids for i in x]) != "".join(new).encode()
               for ids, said in ((a, t.a_bytes), (b, t.b_bytes))):
            good[:] = [all(b"".join([said[i] for i in x]) == w.encode() for x, said in ((x, t.a_bytes), (y, t.b_bytes)))
                       for x, y, w in zip(a, b, new)]
            a, b = ([x if g else [] for x, g in zip(ids, good)] for ids in (a, b))
        n = len(new)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, n) for ids in (a, b))
        ids_a, ids_b = (np.array([i for x in ids for i in x], dtype=np.int64) for ids in (a, b))
        ends_a, ends_b = t.a_len[ids_a].cumsum(), t.b_len[ids_b].cumsum()
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_a, in_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        first_a, first_b = (np.concatenate([[0], x.cumsum()]) for x in (in_a, in_b))
        one = (in_a == 1) & (in_b == 1)
        one[one] = t.same[ids_a[first_a[:-1][one]]] == ids_b[first_b[:-1][one]]
        owner_a = np.repeat(np.arange(n), n_a)
        owner = owner_a[first_a[:-1]] if len(common) else np.zeros(0, dtype=np.int64)
        # A link is a stretch between neighbouring ends of either side: it lies in one token of each.
        ends = np.union1d(ends_a, ends_b)
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        odd = ~one[group_a[link_a]] if len(ends) else np.zeros(0, dtype=bool)
        links = np.stack([ids_a[link_a[odd]], ids_b[link_b[odd]]], axis=1)
        per = np.concatenate([[0], np.bincount(owner, minlength=n).cumsum()])
        # Each group's A ids, then its B ids; an id is written with the mark that follows it.
        code = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64)
        last_a, last_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        last_a[first_a[1:] - 1] = last_b[first_b[1:] - 1] = 1
        code[np.arange(len(ids_a)) + first_b[group_a]] = 2 * ids_a + last_a
        code[np.arange(len(ids_b)) + first_a[group_b + 1]] = 2 * (ids_b + len(t.a_bytes)) + last_b
        shown = list(map(t.marked.__getitem__, code.tolist()))
        bounds = (first_a[per] + first_b[per]).tolist()
        self.groups += ["".join(shown[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, np.diff(per), good], axis=1)])
        self.regular = self._grown(self.regular, ids_a[first_a[:-1][one]], np.bincount(owner[one], minlength=n))
        self.links = self._grown(self.links, links, np.bincount(owner_a[link_a[odd]], minlength=n))

    @staticmethod
    def _grown(pool: tuple, values: np.ndarray, sizes: np.ndarray) -> tuple:
        starts, had = pool
        return np.concatenate([starts, starts[-1] + sizes.cumsum()]), np.concatenate([had, values.astype(np.int32)])

    @staticmethod
    def gather(pool: tuple, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the segments in turn, and how many each has."""
        starts, values = pool
        sizes = starts[at + 1] - starts[at]
        before = sizes.cumsum() - sizes
        return values[np.repeat(starts[at] - before, sizes) + np.arange(sizes.sum())], sizes


def _slices(cells: Sequence[str | bytes]) -> Iterator[slice]:
    """Stretches of cells that hold about ``SLICE`` characters or bytes."""
    start = size = 0
    for i, x in enumerate(cells):
        size += len(x)
        if size >= SLICE:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(cells):
        yield slice(start, len(cells))


def _in_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in _slices((batch["linked_a"] + batch["regular"]).tolist()):
            yield batch.iloc[part]


def align_texts(texts: list[str], table: SegmentTable, spelled: bool) -> Iterator[tuple]:
    """Per text: counts of A tokens, B tokens, groups, links; groups' digest and
    spelling; regular A ids; A ids and B ids of the other links."""
    t = table.t
    a_type, b_type = (np.min_scalar_type(len(x)).newbyteorder("<") for x in (t.a_bytes, t.b_bytes))
    for part in _slices(texts):
        cut = [t.segments(x) if x else [] for x in texts[part]]
        flat = [s for segments in cut for s in segments]
        at = table.look_up(flat)
        ends = np.cumsum([len(x) for x in cut])
        starts = ends - [len(x) for x in cut]
        sums = np.concatenate([np.zeros((1, 4), dtype=np.int64), table.counts[at].cumsum(axis=0)])
        regular, n_regular = table.gather(table.regular, at)
        links, n_links = table.gather(table.links, at)
        regular = regular.astype(a_type)
        linked_a, linked_b = links[:, 0].astype(a_type), links[:, 1].astype(b_type)
        at_regular, at_links = (np.concatenate([[0], x.cumsum()]) for x in (n_regular, n_links))
        spelling, places = table.groups, at.tolist()
        for s, e in zip(starts.tolist(), ends.tolist()):
            n_a, n_b, n_groups, good = (sums[e] - sums[s]).tolist()
            if e == s or good < e - s:
                yield 0, 0, 0, 0, "", "" if spelled else None, b"", b"", b""
                continue
            groups = ";".join(map(spelling.__getitem__, places[s:e]))
            r, k = slice(at_regular[s], at_regular[e]), slice(at_links[s], at_links[e])
            yield (n_a, n_b, n_groups, n_a + n_b - n_groups, hashlib.sha256(groups.encode()).hexdigest(),
                   groups if spelled else None, regular[r].tobytes(), linked_a[k].tobytes(), linked_b[k].tobytes())


def align(docs: DataFrame, a_path: str, b_path: str, spelled: bool = True) -> DataFrame:
    """Alignment of every document: its counts, ``groups`` (``a1,a2|b1;a3|b2,b3``,
    NULL unless ``spelled``) with their digest, and the ids that ``count_pairs``
    and ``score_links`` read, as little-endian numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = SegmentTable.of(a_path, b_path)
        names = [c.split()[0] for c in _LINKS.split(", ")]
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].astype("Int64")
            for part in _slices(texts):
                frame = pd.DataFrame(list(align_texts(texts[part], table, spelled)), columns=names[1:])
                frame.insert(0, "doc_id", ids.iloc[part].array)
                yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(run, _LINKS)


def _numbers(cells: pd.Series, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all cells, and how many each cell has."""
    sizes = cells.map(len).to_numpy(dtype=np.int64) // kind.itemsize
    return np.frombuffer(b"".join(cells), dtype=kind).astype(np.int64), sizes


def count_pairs(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, n: how many links hold each id pair, over all rows of ``aligned``
    (which is read once). Regular groups are summed as a vector by each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = Tokenizers.of(a_path, b_path)
        wide = len(t.b_bytes)
        a_type, b_type = (np.min_scalar_type(len(x)).newbyteorder("<") for x in (t.a_bytes, t.b_bytes))
        vector = np.zeros(len(t.a_bytes), dtype=np.int64)
        keys, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in _in_slices(batches):
            vector += np.bincount(_numbers(batch["regular"], a_type)[0], minlength=len(vector))
            new = _numbers(batch["linked_a"], a_type)[0] * wide + _numbers(batch["linked_b"], b_type)[0]
            new, n = np.unique(new, return_counts=True)
            both, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(place, weights=np.concatenate([sums, n]), minlength=len(both)).astype(np.int64)
            keys = both
            if len(keys) > DISTINCT:
                yield pd.DataFrame({"regular": False, "a": keys // wide, "b": keys % wide, "n": sums})
                keys, sums = keys[:0], sums[:0]
        yield pd.DataFrame({"regular": False, "a": keys // wide, "b": keys % wide, "n": sums})
        a = vector.nonzero()[0]
        yield pd.DataFrame({"regular": True, "a": a, "b": t.same[a], "n": vector[a]})

    parts = materialize(aligned.select("regular", "linked_a", "linked_b")
                        .mapInPandas(run, "regular boolean, a long, b long, n long"), "pair-parts")
    n = F.sum("n").alias("n")
    vector = parts.where("regular").groupBy("a").agg(F.first("b").alias("b"), n)          # as long as the vocabulary
    shuffled = parts.where("NOT regular").groupBy("a", "b").agg(n)
    return shuffled.unionByName(vector).groupBy("a", "b").agg(n)


def score_links(aligned: DataFrame, pairs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """Adds n_best (links whose count is the highest of their B id) and
    count_sum (over the links) to ``aligned``, which has a column ``_row`` that
    numbers its rows. ``pairs`` as from ``count_pairs``, written."""
    spark = aligned.sparkSession
    highest = pairs.groupBy("b").agg(F.max("n").alias("_top"))                            # as long as the vocabulary
    known = materialize(pairs.join(F.broadcast(highest), "b").select("a", "b", "n", (F.col("n") == F.col("_top")).alias("best")),
                        "pair-counts")
    t = Tokenizers.of(a_path, b_path)
    wide = len(t.b_bytes)
    a_type, b_type = (np.min_scalar_type(len(x)).newbyteorder("<") for x in (t.a_bytes, t.b_bytes))
    top = known.orderBy(F.col("n").desc(), "a", "b").limit(frequent).toPandas()
    same = spark.createDataFrame(pd.DataFrame({"a": np.arange(len(t.same)), "b": t.same}), "a long, b long")
    fixed = known.join(F.broadcast(same), ["a", "b"], "left_semi").toPandas()
    key = (top["a"] * wide + top["b"]).to_numpy(dtype=np.int64)
    order = key.argsort()
    vector = np.zeros((len(t.a_bytes), 2), dtype=np.int64)
    vector[fixed["a"], 0], vector[fixed["a"], 1] = fixed["n"], fixed["best"]
    shared = spark.sparkContext.broadcast((key[order], top["n"].to_numpy(dtype=np.int64)[order],
                                           top["best"].to_numpy(dtype=np.int64)[order], vector))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, best, vector = shared.value
        for batch in _in_slices(batches):
            rows, n = np.arange(len(batch)), len(batch)
            ids, sizes = _numbers(batch["regular"], a_type)
            sums = np.zeros((n, 2), dtype=np.int64)
            sums[:, 0], sums[:, 1] = _by_row(vector[ids, 0], sizes), _by_row(vector[ids, 1], sizes)
            a, sizes = _numbers(batch["linked_a"], a_type)
            pair = a * wide + _numbers(batch["linked_b"], b_type)[0]
            row = np.repeat(rows, sizes)
            at = np.searchsorted(keys, pair)
            at[at == len(keys)] = 0
            found = keys[at] == pair if len(keys) else np.zeros(len(pair), dtype=bool)
            sums[:, 0] += _by_row(np.where(found, counts[at] if len(keys) else 0, 0), sizes)
            sums[:, 1] += _by_row(np.where(found, best[at] if len(keys) else 0, 0), sizes)
            rest, rest_sizes = pair[~found], np.bincount(row[~found], minlength=n)
            cuts = rest_sizes.cumsum()[:-1]
            yield pd.DataFrame({"_row": batch["_row"], "count_sum": sums[:, 0], "n_best": sums[:, 1],
                                "rest": np.split(rest, cuts) if n else []})

    partly = materialize(aligned.select("_row", "regular", "linked_a", "linked_b")
                         .mapInPandas(run, "_row long, count_sum long, n_best long, rest array<long>"), "link-sums")
    rest = partly.where(F.size("rest") > 0).select("_row", F.explode("rest").alias("_pair"))
    by_pair = known.select((F.col("a") * wide + F.col("b")).alias("_pair"), "n", F.col("best").cast("long").alias("best"))
    more = rest.join(by_pair, "_pair").select("_row", F.col("n").alias("count_sum"), F.col("best").alias("n_best"))
    sums = (partly.select("_row", "count_sum", "n_best").unionByName(more)
            .groupBy("_row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")))
    return aligned.drop("regular", "linked_a", "linked_b").join(sums, "_row")


def _by_row(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    total = np.concatenate([[0], values.cumsum()])
    ends = sizes.cumsum()
    return total[ends] - total[ends - sizes]


def alignment_report(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    aligned = materialize(align(docs, a_path, b_path, spelled=False).drop("groups")
                          .withColumn("_row", F.monotonically_increasing_id()), "aligned")
    pairs = materialize(count_pairs(aligned, a_path, b_path), "pairs")
    return score_links(aligned, pairs, a_path, b_path, frequent).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

"""Best-fit packing by sum of squares.

Documents become token ids, ids are cut into pieces of at most ``length``, and
pieces are packed into sequences of at most ``length``. The rule: let N(g) be
the number of open sequences with g free places; a piece goes into the open
sequence that leaves the sum of N(g)^2 smallest. A new sequence is opened only
where a piece fits none: letting it compete, as the rule for items that arrive
one by one does, costs one to two per cent more sequences here, where the
pieces of a shard are known and come longest first.

Scale: token ids never leave the task that makes them (a piece is shuffled as
its length and checksum). Pieces are numbered where they are written and dealt
by a hash of the number to shards of about ``shard`` pieces, so rows that repeat
spread as well; each shard is packed by itself with at most ``length`` counters,
so memory and time of a task don't depend on the input's size. A shard ends with a
few sequences that aren't full; at the default size that is well under one
per mille.

Tokenizing: texts of common letters run through ``tiktoken`` with the merges of
the same file, several times faster than the library itself. A text that holds
a special string or rarer scripts is cut before blanks, and around newlines,
that stand alone between non-blanks, since the byte-level pattern joins nothing
across, and its parts with such characters go to the library. Tests hold both
ways to the library's ids.

Defined cases: NULL text is the empty text (one id, the end id); repeated rows
are packed each; NULL doc_id stays NULL; an empty table gives no rows; ties are
broken by the smallest free space.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, rows_and

LENGTH = 2048
SHARD = 40_000
_RUN = 4096                     # copies of one piece numbered by one task
# Fixed value: the pattern that byte-level pre-tokenizers of this kind split by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_COMMON = "\u0250"              # letters below it are classed alike by every Unicode version
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# White space other than blanks and newlines that stand alone between words.
_ODD_BLANKS = re.compile(r"[^\S \n]|[ \n]{2}|\A[ \n]|[ \n]\Z|\x1c|\x1d|\x1e|\x1f")


def parts_of(text: str) -> list[str]:
    """The text in parts whose ids are those of the whole."""
    if _ODD_BLANKS.search(text):
        first, *rest = text.split(" ")
        parts = [first]
        for p in rest:
            if p and not p[0].isspace():
                parts.append(" " + p)
            else:                  # a longer run of white space stays with what precedes it
                parts[-1] += " " + p
        return parts
    parts = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        parts.append(first)
        parts += [" " + p for p in rest]
        parts.append("\n")
    return parts[:-1]


def _merges(path: str) -> tuple[dict[bytes, int], np.ndarray] | None:
    """Ranks of the byte strings of a plain byte-level BPE, and the id of each
    rank; None for a tokenizer of another kind."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or spec["normalizer"] or spec["post_processor"] or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout")
            or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix")):
        return None
    # Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    char = {chr(b): b for b in shown}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    token = {c: bytes([b]) for c, b in char.items()}
    ranks, ids = {}, []
    for c, b in sorted(char.items(), key=lambda x: x[1]):
        ranks[bytes([b])] = len(ranks)
        ids.append(model["vocab"][c])
    for m in model["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ")
        whole = token.setdefault(a + b, token[a] + token[b])
        if whole not in ranks:
            ranks[whole] = len(ranks)
            ids.append(model["vocab"][a + b])
    return ranks, np.array(ids, dtype="<u4")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([f"[{_COMMON}-\U0010ffff]", *map(re.escape, specials)]))
        self.fast = None
        if found := _merges(path):
            import tiktoken
            self.fast = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=found[0], special_tokens={})
            self.ids = found[1]

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode(self, text: str) -> bytes:
        if self.fast is None:
            return self._library([text])[0]
        if not self.odd.search(text):
            return self._merged(text)
        parts = parts_of(text)
        rare = [p for p in parts if self.odd.search(p)]
        known = dict(zip(rare, self._library(rare)))
        return b"".join(known[p] if p in known else self._merged(p) for p in parts)

    def _merged(self, text: str) -> bytes:
        return self.ids[self.fast.encode_to_numpy(text, disallowed_special=())].tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first may be shorter."""
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """One row per piece of every document."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer)
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"].tolist(), b["text"].fillna("")):
                ids = encoder.encode(text) + end
                out += [(doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]))
                        for i, (s, n) in enumerate(cut(len(ids) // 4, length))]
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, _PIECES)


def sum_of_squares(sizes: list[int], length: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each size, placed in the given order."""
    count = np.zeros(length + 1, dtype=np.int64)     # open bins by free space; 0 and `length` stay 0
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets, made = [], [], 0
    for s in sizes:
        if s >= length:
            bins.append(made)
            offsets.append(0)
            made += 1
            continue
        # Change of the sum if a bin with g free places (g > s) gets the piece.
        change = 2 * (count[1:length - s] - count[s + 1:length]) + 2
        change[count[s + 1:length] == 0] = np.iinfo(np.int64).max
        g, best = 0, None
        if count[s]:                                                # an exact fit closes a bin
            g, best = s, 1 - 2 * int(count[s])
        if change.size:
            i = int(change.argmin())
            if count[s + 1 + i] and (best is None or change[i] < best):
                g = s + 1 + i
        if g:
            b = open_bins[g].pop()
            count[g] -= 1
        else:
            b, g = made, length
            made += 1
        bins.append(b)
        offsets.append(length - g)
        if g > s:
            count[g - s] += 1
            open_bins[g - s].append(b)
    return bins, offsets


def pack(cut_pieces: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Adds sequence_id and offset. Full pieces are sequences of their own; the
    others are packed per shard, longest first, so short pieces fill the rest."""
    table = materialize(cut_pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    short = table.where(F.col("length") < length)
    n = rows_and(short)["n"]
    shards = max(1, -(-n // shard))
    schema = _PIECES + ", sequence_id long, offset long"

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "ids_crc32", "doc_id", "piece", "start"],
                                  ascending=[False, True, True, True, True], kind="stable")
        bins, offsets = sum_of_squares(group["length"].tolist(), length)
        group["sequence_id"] = np.asarray(bins, dtype=np.int64) * shards + int(key[0])
        group["offset"] = np.asarray(offsets, dtype=np.int64)
        return group.drop(columns=["_row", "_shard"])

    dealt = F.pmod(F.xxhash64("_row"), F.lit(shards))
    packed = (short.withColumn("_shard", dealt).repartition(shards, "_shard").groupBy("_shard")
              .applyInPandas(run, schema))
    return packed.unionByName(_alone(table.where(F.col("length") >= length).drop("_row"), shard)
                              .withColumn("offset", F.lit(0).cast("long")))


def _alone(full: DataFrame, shard: int) -> DataFrame:
    """Full pieces as sequences of their own: negative numbers, free of those of
    shards. They follow from the pieces, not from where these lie: equal pieces
    are counted, counts are summed up inside buckets of about ``shard``
    different pieces, and a piece's copies take the numbers below the sum, in
    runs so that many copies spread over tasks."""
    names = full.columns
    equal = materialize(full.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")), "full-pieces")
    buckets = max(1, -(-rows_and(equal)["n"] // shard))
    bucket = F.pmod(F.xxhash64(*names), F.lit(buckets))
    before = Window.partitionBy("_bucket").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    begun = equal.withColumn("_bucket", bucket).withColumn("_begun", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = begun.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_RUN).cast("long"))))
    copies = F.sequence(F.col("_run"), F.least(F.col("_run") + _RUN, F.col("_n")) - 1)
    spread = runs.repartition(F.xxhash64(*names, "_run")).withColumn("_copy", F.explode(copies))
    return spread.select(*names, (-1 - F.col("_bucket") - F.lit(buckets) * (F.col("_begun") + F.col("_copy"))).alias("sequence_id"))


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0,
                   shard: int = SHARD) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, length, end_id), length, shard)

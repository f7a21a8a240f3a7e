"""Substring de-duplication by content-defined chunking.

A gear hash over the last 16 bytes decides where a chunk ends, so an insertion
shifts the borders near it only and equal passages give equal chunks wherever
they stand. Chunks are known by a 128-bit digest. The first holder of a digest
(smallest doc_id, then place) keeps it; further ones lose it where chunks of
other documents in a row cover at least ``min_bytes``, so that no chance
agreement of a few words cuts a text. With ``inside``, a passage's further
places within one document count as well; without it, a passage that only one
document holds, however often, is left to it. The bytes between a passage's ends
and the next borders stay.

Scale: a task sends 16-byte digests with their places, never texts. The count
per digest is partially aggregated; the repeated digests are written as a table
and joined back, a plain equi-join whose hot keys Spark can split. Only
repeated chunks go on to be put together per document.

Defined cases: NULL text is the empty text (no chunks); texts under the
smallest chunk are one chunk; rows that repeat in full count as one document
and get equal results; a NULL doc_id sorts first; ties of doc_id are broken by
content; an empty table gives an empty result; other columns pass through
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, packed, row_keys, text_of, unpacked

MIN_CHUNK, MAX_CHUNK = 8, 256
CUT_BITS = 4                   # a border after every 16 bytes or so
MIN_BYTES = 100                # repeated chunks in a row shorter than this stay
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def borders(raw: bytes) -> list[int]:
    """End positions of the chunks of a text."""
    n = len(raw)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(raw, dtype=np.uint8)]
    for s in (1, 2, 4, 8):                 # window of 16 bytes by doubling
        wider = h.copy()
        wider[s:] += h[:-s] << np.uint32(s)
        h = wider
    ends, at = [], 0
    for e in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while e - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
        if e - at >= MIN_CHUNK:
            at = e
            ends.append(at)
    while n - at > MAX_CHUNK:
        at += MAX_CHUNK
        ends.append(at)
    if n > at:
        if n - at < MIN_CHUNK and ends:    # a short rest belongs to the last chunk
            ends[-1] = n
        else:
            ends.append(n)
    return ends


_SIZES = 512                   # more than a chunk's bytes
_SLICE = 500                   # texts whose chunks a worker holds at once


def chunks(docs: DataFrame) -> DataFrame:
    """_k1, doc_id, at, digest of every chunk; ``at`` is its start and size in one
    number. A document is known by its doc_id and a hash of its content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (whole.iloc[i:i + _SLICE] for whole in batches for i in range(0, len(whole), _SLICE)):
            places, digests = [], []
            for t in b["text"]:
                raw = t.encode("utf-8")
                ends = borders(raw)
                s = [0, *ends[:-1]] if ends else []
                places.append([f * _SIZES + e - f for f, e in zip(s, ends)])
                digests.append([xxhash.xxh3_128_digest(raw[f:e]) for f, e in zip(s, ends)])
            yield pd.DataFrame({"_k1": b["_k1"], "doc_id": b["doc_id"].astype("Int64"), "places": places, "digests": digests})

    rows = docs.select(row_keys("doc_id", "text")[0], F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return (rows.mapInPandas(run, "_k1 long, doc_id long, places array<long>, digests array<binary>")
            .select("_k1", "doc_id", F.explode(F.arrays_zip("places", "digests")).alias("c"))
            .select("_k1", "doc_id", F.col("c.places").alias("at"), F.col("c.digests").alias("digest")))


def mark_chunks(docs: DataFrame, inside: bool = False) -> DataFrame:
    """Per document (_k1, _doc) the array ``marks`` of its chunks that other documents
    (with ``inside``, other places) hold too: ``at`` doubled, plus 1 where this
    place is the first holder (numbers, since a worker reads many at once)."""
    every = chunks(docs)
    place = F.struct("doc_id", "_k1", "at")
    repeated = (every.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .where("first._k1 <> last._k1" + (" or first.at <> last.at" if inside else ""))
                .select("digest", "first"))
    repeated = materialize(repeated, "repeated-chunks")
    mark = F.col("at") * 2 + place.eqNullSafe(F.col("first")).cast("long")
    return (every.join(repeated, "digest").select("_k1", F.col("doc_id").alias("_doc"), mark.alias("mark"))
            .groupBy("_k1", "_doc").agg(F.collect_set("mark").alias("marks")))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows (with ``_k1`` and ``_doc``) and the marks of their chunks, if any."""
    m = marks.select(F.col("_k1").alias("_mk"), F.col("_doc").alias("_md"), "marks")
    return rows.join(m, (F.col("_k1") == F.col("_mk")) & F.col("_doc").eqNullSafe(F.col("_md")), "left").drop("_mk", "_md")


def runs(marks: list[tuple[int, int]], min_bytes: int) -> list[tuple[int, int]]:
    """(start, end) of chunks that follow each other and cover enough bytes."""
    out: list[list[int]] = []
    for start, size in sorted(marks):
        if out and out[-1][1] == start:
            out[-1][1] = start + size
        else:
            out.append([start, start + size])
    return [(s, e) for s, e in out if e - s >= min_bytes]


def _spans(marks, first_too: bool, min_bytes: int) -> list[tuple[int, int]]:
    return [] if marks is None else runs([divmod(int(m) >> 1, _SIZES) for m in marks if first_too or not m & 1], min_bytes)


def chunk_report(docs: DataFrame, min_bytes: int = MIN_BYTES, inside: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, repeated (holds a passage that other
    documents, with ``inside`` other places, hold too), dropped_bytes, spans (byte ranges dropped, in order)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            spans = [_spans(m, False, min_bytes) for m in b["marks"]]
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"), "n_bytes": b["n_bytes"],
                "repeated": [bool(_spans(m, True, min_bytes)) for m in b["marks"]],
                "dropped_bytes": [sum(e - s for s, e in x) for x in spans],
                "spans": [[{"start": s, "end": e} for s, e in x] for x in spans]})

    rows = docs.select(row_keys("doc_id", "text")[0], F.col("doc_id").cast("long").alias("_doc"),
                       F.octet_length(text_of("text")).cast("long").alias("n_bytes"))
    return (_marked(rows, mark_chunks(docs, inside)).select(F.col("_doc").alias("doc_id"), "n_bytes", "marks")
            .mapInPandas(run, "doc_id long, n_bytes long, repeated boolean, dropped_bytes long, "
                              "spans array<struct<start:int,end:int>>"))


def dedup_chunks(docs: DataFrame, min_bytes: int = MIN_BYTES, inside: bool = False) -> DataFrame:
    """The documents, same columns and rows, without their dropped spans (a cut
    inside a character drops that character's rest too)."""
    kept = _kept_text(min_bytes)
    whole = packed(docs, row_keys("doc_id", "text")[0], F.col("doc_id").cast("long").alias("_doc"))
    joined = _marked(whole, mark_chunks(docs, inside))
    return unpacked(joined, docs.columns, text=F.when(F.col("marks").isNull(), F.col("_row")["text"])
                    .otherwise(kept(F.col("_row")["text"], F.to_json("marks"))))


def _kept_text(min_bytes: int):
    import json

    @F.pandas_udf("string")
    def kept(text: pd.Series, marks: pd.Series) -> pd.Series:
        out = []
        for t, m in zip(text, marks):
            if t is None or m is None:
                out.append(t)
                continue
            raw, at, parts = t.encode("utf-8"), 0, []
            for s, e in _spans(json.loads(m), False, min_bytes):
                parts.append(raw[at:s])
                at = e
            out.append(b"".join([*parts, raw[at:]]).decode("utf-8", "ignore"))
        return pd.Series(out, dtype="object")

    return kept

"""Line de-duplication: explode normalised lines, hash them, count the
documents of each hash, drop lines over the threshold, put the rest together
by position. Native DataFrame functions only.

Scale: the first shuffle carries 16-byte hashes after a per-document distinct
and a map-side partial count, so a line that a third of all documents hold
costs one partial row per task. The frequent hashes are written as a table;
joining the lines to it is a plain equi-join whose hot keys Spark's skew rule
can split. Texts move once, in the last join, keyed by row.

Defined cases: NULL or empty text is one empty line; an empty line is never
dropped; NULL ``doc_id`` is an ordinary value; fully repeated rows count as
that many documents and get equal results; an empty table gives an empty one;
other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BLANKS, lower_ascii, materialize, packed, row_keys, text_of, unpacked


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(71), key).alias("h2")]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """Hashes (h1, h2) of line keys found in at least ``min_docs`` documents."""
    keys = docs.select(F.explode(F.array_distinct(
        F.transform(_lines(text_of("text")), line_key))).alias("key"))
    return (keys.where(F.length("key") >= min_chars).select(*_hashes(F.col("key")))
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_docs).select("h1", "h2"))


def mark_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``_row`` (all input columns), ``lines`` (array) and ``kept`` (positions
    of the surviving lines, in order) for every input row."""
    frequent = materialize(frequent_lines(docs, min_docs, min_chars), "frequent-lines")
    placed = docs.select(*row_keys("doc_id", "text"),
                         F.posexplode(_lines(text_of("text"))).alias("pos", "line"))
    key = line_key(F.col("line"))
    placed = (placed.where(F.length(key) >= min_chars)
              .select("_k1", "_k2", "pos", *_hashes(key)))
    dropped = (placed.join(frequent, ["h1", "h2"])
               .groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("dropped")))
    whole = packed(docs, *row_keys("doc_id", "text"), _lines(text_of("text")).alias("lines"))
    positions = F.sequence(F.lit(0), F.size("lines") - 1)
    return (whole.join(dropped, ["_k1", "_k2"], "left")
            .withColumn("kept", F.when(F.col("dropped").isNull(), positions)
                        .otherwise(F.array_except(positions, F.col("dropped"))))
            .select("_row", "lines", "kept"))


def kept_text() -> Column:
    return F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The documents, same columns and rows, without their frequent lines;
    ``n_chars``, where present, follows the new text. A NULL text stays NULL."""
    marked = mark_lines(docs, min_docs, min_chars)
    text = F.when(F.col("_row")["text"].isNotNull(), kept_text())
    new = {"text": text}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.length(text).cast(kind)
    return unpacked(marked, docs.columns, **new)


def line_report(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per row: doc_id, lines before, lines dropped, SHA-256 of the kept text."""
    marked = mark_lines(docs, min_docs, min_chars)
    return marked.select(
        F.col("_row")["doc_id"].alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.encode(kept_text(), "UTF-8"), 256).alias("kept_sha256"))

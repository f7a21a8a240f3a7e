"""Helpers shared by the operators of this package.

Operators identify a row by its content, not by ``doc_id`` alone: two 64-bit
hashes over the named columns. Rows that repeat in full therefore share a key
and, wherever a result is joined back, get the same result. ``packed`` moves
all input columns into one struct so that no operator column can clash with a
column of the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

WORD = r"[^\x20\x09-\x0D]+"          # a word: a run without ASCII blanks
BLANKS = " \t\n\x0b\f\r"             # the blanks that end a word
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["WORD", "BLANKS", "lower_ascii", "text_of", "row_keys", "packed", "unpacked",
           "materialize", "rows_and", "quoted"]


def quoted(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def text_of(c: str | Column = "text") -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def row_keys(*cols: str) -> list[Column]:
    """Two independent 64-bit hashes of the columns (``_k1``, ``_k2``)."""
    cs = [F.struct(F.col(c).isNull(), F.col(c)) for c in cols]
    return [F.xxhash64(*cs).alias("_k1"), F.xxhash64(F.lit(71), *cs).alias("_k2")]


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """``df`` with all its columns inside the struct ``_row``, and ``more``."""
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), *more)


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``_row`` again, with some replaced by other expressions."""
    return df.select(*[(replaced[c] if c in replaced else F.col("_row")[c]).alias(c)
                       for c in columns])


def rows_and(df: DataFrame, *aggs: Column):
    """Row count and other scalar aggregates of a table, as one driver row."""
    return df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()

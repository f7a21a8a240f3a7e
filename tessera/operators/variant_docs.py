"""Lookups over documents whose fields have no declared type.

A document is one VARIANT column. A field of it may hold a number in one
document, a text in the next, an explicit null or nothing at all; the four
stay apart: a range test takes numbers only (a text of digits is no number),
``is_present`` tells a null field from an absent one, and nothing is coerced.

Paths are dotted names below the document's root (``a.b``). Every function is a
native expression; a field's type is read from its variant header, so the
document isn't parsed again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names as ``type_of`` gives them.
MISSING, NULL, NUMBER, TEXT, BOOLEAN, LIST, RECORD, OTHER = (
    "missing", "null", "number", "text", "boolean", "list", "record", "other")
_NUMBERS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def parse_documents(df: DataFrame, json_col: str, out: str = "doc") -> DataFrame:
    """The rows with their JSON text as a VARIANT; NULL where it is no JSON."""
    return df.withColumn(out, F.try_parse_json(F.col(json_col))).drop(*([json_col] if json_col != out else []))


def json_path(path: str) -> str:
    """``a.b`` as the path that variant functions read, names quoted."""
    names = path.split(".")
    if not all(names) or any(re.search(r"['\"\]]", n) for n in names):
        raise ValueError(f"not a dotted path: {path!r}")
    return "$" + "".join(f"['{n}']" for n in names)


def field(doc: str, path: str) -> Column:
    """The field as a VARIANT: SQL NULL if absent, a variant null if null."""
    return F.try_variant_get(F.col(doc), json_path(path), "variant")


def type_of(doc: str, path: str) -> Column:
    """One of the type names above, never NULL."""
    kind = F.schema_of_variant(field(doc, path))
    return (F.when(kind.isNull(), MISSING).when(kind == "VOID", NULL)
            .when(kind.isin(*_NUMBERS) | kind.startswith("DECIMAL"), NUMBER)
            .when(kind == "STRING", TEXT).when(kind == "BOOLEAN", BOOLEAN)
            .when(kind.startswith("ARRAY"), LIST).when(kind.startswith("OBJECT"), RECORD).otherwise(OTHER))


def is_present(doc: str, path: str) -> Column:
    """The field exists, be it null."""
    return field(doc, path).isNotNull()


def is_null(doc: str, path: str) -> Column:
    """The field exists and is null."""
    return F.coalesce(F.is_variant_null(field(doc, path)), F.lit(False))


def number(doc: str, path: str, kind: str = "double") -> Column:
    """The field if it is a number (of any width), else NULL."""
    return F.when(type_of(doc, path) == NUMBER, F.try_variant_get(F.col(doc), json_path(path), kind))


def text(doc: str, path: str) -> Column:
    """The field if it is a text, else NULL (numbers aren't spelled out)."""
    return F.when(type_of(doc, path) == TEXT, F.try_variant_get(F.col(doc), json_path(path), "string"))


def number_in_range(doc: str, path: str, low, high, low_inclusive: bool = False, high_inclusive: bool = True) -> Column:
    """F5 with its type guard: the field is a number in the range."""
    n = number(doc, path)
    above = n >= low if low_inclusive else n > low
    below = n <= high if high_inclusive else n < high
    return F.coalesce(above & below, F.lit(False))


def text_element_matches(doc: str, path: str, pattern: str) -> Column:
    """the field is a list with a text element that matches, or such a text
    itself, as the source's database reads a pattern on an array field."""
    items = F.when(type_of(doc, path) == LIST, F.try_variant_get(F.col(doc), json_path(path), "array<variant>"))
    in_list = F.exists(items, lambda v: F.coalesce(
        F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string").rlike(pattern)), F.lit(False)))
    return F.coalesce(in_list, text(doc, path).rlike(pattern), F.lit(False))


def find_documents(df: DataFrame, doc: str, predicate: Column, projection: dict[str, tuple[str, str]],
                   sort_by: list[str]) -> DataFrame:
    """S4 + P5 + O1: documents that pass, their fields by (path, type) under new
    names, sorted by the named columns, NULLs first."""
    chosen = {name: number(doc, path, kind) if kind != "string" else text(doc, path)
              for name, (path, kind) in projection.items()}
    found = df.where(predicate).select(*[c.alias(name) for name, c in chosen.items()])
    return found.orderBy(*[F.col(c).asc_nulls_first() for c in sort_by])


def count_types(df: DataFrame, doc: str, paths: list[str]) -> DataFrame:
    """path, type, n: what each path holds, over all documents (one pass; as
    many partial counts per task as there are paths and types)."""
    each = F.array(*[F.struct(F.lit(p).alias("path"), type_of(doc, p).alias("type")) for p in paths])
    return df.select(F.inline(each)).groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


def as_text(df: DataFrame, doc: str, out: str = "json") -> DataFrame:
    """VARIANT documents as JSON text again: null fields stay, absent ones don't appear."""
    return df.withColumn(out, F.to_json(F.col(doc))).drop(*([doc] if doc != out else []))

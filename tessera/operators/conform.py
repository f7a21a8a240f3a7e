"""Column-set shaping (P1-P7, F2): conditional derivation, drop, conform to a
declared schema, document assembly and sparse JSON. All are projections, so
they fuse into the neighbouring whole-stage-codegen span."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import null_tokens


def derive_if_present(df: DataFrame, rules: dict[str, tuple[str, Callable[[str], Column]]]) -> DataFrame:
    """``{new: (source, fn)}`` -- add ``new = fn(source)`` only when
    ``source`` is a column of ``df``; ``fn`` receives the column name (the
    library's functions accept names or Columns). One projection for all
    rules."""
    todo = {new: fn(src) for new, (src, fn) in rules.items() if src in df.columns}
    return df.withColumns(todo) if todo else df


def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns whose name starts with ``Unnamed`` or is blank."""
    keep = [c for c in df.columns if not (c.startswith("Unnamed") or c.strip() == "")]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def conform(df: DataFrame, schema: T.StructType | list[tuple[str, str]]) -> DataFrame:
    """Exactly the declared columns, in order; missing ones are NULL of
    the declared type, present ones are cast to it."""
    fields = schema.fields if isinstance(schema, T.StructType) else \
        [T.StructField(n, T._parse_datatype_string(t)) for n, t in schema]
    out = []
    for f in fields:
        if f.name in df.columns:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def drop_all_null(df: DataFrame, subset: list[str] | None = None,
                  exclude: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """drop rows that are NULL in every column of ``subset`` (default:
    all columns except ``exclude``). ``strict`` (H3): a text that means "no
    value" (empty, ``None``, ...) counts as NULL too."""
    cols = subset if subset is not None else [c for c in df.columns if c not in exclude]
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if not strict:
        return df.dropna(how="all", subset=cols)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    values = [null_tokens(F.col(f"`{c}`")).isNotNull() if c in texts else F.col(f"`{c}`").isNotNull() for c in cols]
    return df.where(F.array_contains(F.array(*values), True))


def sparse_json(df: DataFrame, cols: list[str], out: str = "json") -> DataFrame:
    """A JSON object text per row where NULL fields are absent (empty
    lists and maps are kept). Only top-level fields are left out: a NULL
    inside a record, list or map stays."""
    def member(c: str) -> Column:
        text = F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"})
        return F.when(F.col(c).isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2))

    return df.withColumn(out, F.concat(F.lit("{"), F.concat_ws(",", *[member(c) for c in cols]), F.lit("}")))


def json_key_count(c) -> Column:
    """Number of top-level keys in a JSON object text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.size(F.json_object_keys(col)).cast("bigint")

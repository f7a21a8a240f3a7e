"""CSV interchange.

The source passes data between stages as CSV with every column read as text
and empty cells kept as empty strings. Reads here use a declared all-string
schema (never inference), a header, multi-line quoted cells and ``"`` as both
quote and escape (doubled quotes). Writes keep leading/trailing whitespace
and flatten arrays/maps first (``"; "``-joined lists, JSON maps).

Spark's reader of multi-line cells takes a file whole, one task each. Files of
other writers are read in splits with ``parallel`` (``foreign_csv``). Files that
only this library reads may be written ``splittable``: line breaks and
backslashes inside cells are escaped, a record is one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_READ_OPTS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

_WRITE_OPTS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_text_csv(spark: SparkSession, path: str, columns: list[str],
                  keep_empty: bool = True, backslash_escapes: bool = False,
                  splittable: bool = False, parallel: bool = False, position: str | None = None) -> DataFrame:
    """CSV with a declared all-text schema. ``keep_empty`` turns
    missing cells into ``""`` as the source's reader does (a short row's
    absent cells included). ``backslash_escapes`` reproduces a reader that
    treats ``\\`` as an escape character: every backslash is dropped and the
    character after it kept (``a\\xa0b`` reads as ``axa0b``). Quotes are
    always read with doubled-quote escaping, which is what the files use.
    ``splittable``: the files were written so by ``write_csv``. ``parallel``:
    multi-line files of any writer, read in splits (``foreign_csv``);
    ``position`` then names a column that numbers the rows in their order."""
    if parallel:
        from .foreign_csv import read_foreign_csv
        df = read_foreign_csv(spark, path, columns, position)
    else:
        df = _read_files(spark, path, columns, splittable)
    if backslash_escapes:
        text = [F.regexp_replace(F.col(f"`{c}`"), r"\\(.)", "$1").alias(c) for c in columns]
        df = df.select(*text, *([position] if parallel and position else []))
    return df.na.fill("") if keep_empty else df


def _read_files(spark: SparkSession, path: str, columns: list[str], splittable: bool) -> DataFrame:
    opts = _READ_OPTS | {"multiLine": "false"} if splittable else _READ_OPTS
    df = spark.read.schema(all_string_schema(columns)).options(**opts).csv(path)
    if splittable:
        df = df.select(*[_unescape_breaks(F.col(f"`{c}`")).alias(c) for c in columns])
    return df


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Arrays become ``"; "``-joined text (NULL entries as ``None``); maps and
    structs become JSON text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.AtomicType):
            out.append(F.array_join(c.cast("array<string>"), "; ", "None").alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def _escape_breaks(c: Column) -> Column:
    for char, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(char), F.lit(escaped))
    return c


def _unescape_breaks(c: Column) -> Column:
    """Between doubled backslashes every backslash begins a line break."""
    parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(c.contains("\\"), F.array_join(parts, "\\")).otherwise(c)


def write_csv(df: DataFrame, path: str, splittable: bool = False) -> None:
    """K1/K4: header, UTF-8, minimal quoting, whitespace preserved.
    ``splittable``: one line per record, for ``read_text_csv(splittable=True)``."""
    df = flatten_for_csv(df)
    if splittable:
        df = df.select(*[(_escape_breaks(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType)
                          else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    df.write.mode("overwrite").options(**_WRITE_OPTS).csv(path)

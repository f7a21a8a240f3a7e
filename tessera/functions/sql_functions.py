"""The normalisers as SQL functions (U1-U4), for queries written in SQL.

``register(spark)`` makes temporary SQL functions of the session: scalar ones
with an expression as body, and a table function for list elements. Spark
inlines the bodies, so a query over them is one native plan without Python, and
Catalyst pushes filters through them as through any expression. Patterns and
bounds are those of ``functions.scalars``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import scalars as S


def _text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _extracted(text: str, pattern: str) -> str:
    return f"nullif(regexp_extract({text}, {_text(pattern)}, 1), '')"


def _within(text: str, most: int) -> str:
    return f"CASE WHEN try_cast({text} AS INT) BETWEEN 1 AND {most} THEN try_cast({text} AS INT) END"


def _strip(text: str) -> str:
    return f"btrim({text}, {_text(S._WHITE_SPACE)})"


_TOKENS = "|".join(t for t in S.NULL_TOKENS if t)
_SEP1, _SEP2 = S.MULTI_SEP_FIRST, S.MULTI_SEP_SECOND

#: name -> (parameters, result, body). A body may use the functions before it (not inside a lambda).
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "strip_text": ("x STRING", "STRING", _strip("x")),
    "t1b_value": ("x STRING", "STRING", f"nullif(regexp_replace(strip_text(x), {_text(f'(?i)^({_TOKENS})$')}, ''), '')"),
    "t1a_value": ("x STRING", "STRING", f"t1b_value(translate(x, {_text(S.CHAR_FROM)}, {_text(S.CHAR_TO)}))"),
    "t3_int": ("x STRING", "BIGINT", f"try_cast({_extracted('t1a_value(x)', S.FIRST_DIGITS_RE)} AS BIGINT)"),
    "t4_decimal": ("x STRING", "DOUBLE",
                   f"try_cast(replace({_extracted('t1a_value(x)', S.NUMBER_RE)}, ',', '.') AS DOUBLE)"),
    "t10_parts": ("x STRING", "ARRAY<STRING>",
                  "CASE WHEN t1b_value(x) IS NULL THEN CAST(array() AS ARRAY<STRING>) "
                  f"WHEN contains(x, {_text(_SEP1)}) THEN filter(transform(split(t1b_value(x), {_text(chr(92) + _SEP1)}), "
                  f"p -> {_strip('p')}), p -> p <> '') "
                  f"WHEN contains(x, {_text(_SEP2)}) THEN filter(transform(split(t1b_value(x), {_text(_SEP2)}), "
                  f"p -> {_strip('p')}), p -> p <> '') ELSE array(t1b_value(x)) END"),
    "t12_id": ("x STRING", "INT",
               f"CASE WHEN {_extracted('t1a_value(x)', '(?U)' + S.HASH_ID_RE)} IS NOT NULL "
               f"THEN {_within(_extracted('t1a_value(x)', '(?U)' + S.HASH_ID_RE), S.MAX_DEX_ID)} "
               f"WHEN contains(lower(t1a_value(x)), {_text(S.ID_REFUSE_WORD)}) THEN NULL "
               f"ELSE {_within(_extracted('t1a_value(x)', '(?U)' + S.BARE_ID_RE), S.MAX_DEX_ID)} END"),
    "t13_level": ("x STRING", "INT",
                  f"CASE WHEN {_extracted('t1a_value(x)', S.LEVEL_TAG_RE)} IS NOT NULL "
                  f"THEN {_within(_extracted('t1a_value(x)', S.LEVEL_TAG_RE), S.MAX_LEVEL)} "
                  f"WHEN contains(t1a_value(x), {_text(S.LEVEL_REFUSE[0])}) "
                  f"OR contains(lower(t1a_value(x)), {_text(S.LEVEL_REFUSE[1])}) THEN NULL "
                  f"ELSE {_within(_extracted('t1a_value(x)', '(?U)' + S.LEVEL_STRICT_RE), S.MAX_LEVEL)} END"),
}

#: Table functions: one row per list element (U4); an empty or NULL list gives none.
TABLE_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "u4_elements": ("list ARRAY<STRING>", "TABLE(pos INT, elem STRING)", "SELECT pos, col FROM posexplode(list)"),
}


def register(spark: SparkSession) -> list[str]:
    """Make (or replace) the functions in the session; returns their names."""
    for name, (takes, gives, body) in (FUNCTIONS | TABLE_FUNCTIONS).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
    return [*FUNCTIONS, *TABLE_FUNCTIONS]

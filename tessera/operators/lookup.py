"""Predicates, counts and sorted lookups over document collections
(F3-F6, G1, G2, P5, P8, O1, O2, S4).

Filters use plain comparisons on (nested) columns where possible so that the
Parquet scan receives them as pushed filters and reads only the referenced
leaves; the array predicate (a lambda) stays a post-scan filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The type names the water query accepts (case-insensitive).
WATER_PATTERN = r"(?iu)^(water|água)$"


def has_at_least(array_col: str, n: int) -> Column:
    """the array exists and has at least ``n`` elements."""
    return F.coalesce(F.size(F.col(array_col)) >= n, F.lit(False))


def any_element_matches(array_col: str, pattern: str) -> Column:
    """some element matches ``pattern`` (Java regex, use ``(?iu)``)."""
    return F.coalesce(F.exists(F.col(array_col), lambda t: t.rlike(pattern)), F.lit(False))


def in_range(path: str, low, high, low_inclusive: bool = False, high_inclusive: bool = True) -> Column:
    """numeric range on a (nested) path; a missing path is not in range."""
    c = F.col(path)
    lo = c >= low if low_inclusive else c > low
    hi = c <= high if high_inclusive else c < high
    return lo & hi


def count_where(df: DataFrame, predicate: Column, alias: str = "n") -> DataFrame:
    """G1: filtered global count as a one-row DataFrame (partial counts per
    partition, one final row)."""
    return df.where(predicate).agg(F.count(F.lit(1)).alias(alias))


def result_size(df: DataFrame, alias: str = "n") -> DataFrame:
    """Size of a result set, computed where the data is."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def find_sorted(df: DataFrame, predicate: Column, projection: dict[str, str],
                sort_key: str, tie_break: list[str] | None = None) -> DataFrame:
    """S4 + F6 + P5 + O1: filter, project (nested paths allowed) and sort
    ascending by ``sort_key`` with NULLs first; ties broken by ``tie_break``."""
    proj = [F.col(path).alias(alias) for alias, path in projection.items()]
    order = [F.col(sort_key).asc_nulls_first()] + [F.col(t).asc_nulls_first() for t in (tie_break or [])]
    return df.where(predicate).select(*proj).orderBy(*order)


def last_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """O2: the last ``n`` rows by an explicit order (top-k; no full sort)."""
    return df.orderBy(F.col(order).desc()).limit(n)


def multi_type_count(docs: DataFrame, types_col: str = "tipos", n: int = 2) -> DataFrame:
    """Query (a): documents with at least ``n`` types."""
    return count_where(docs, has_at_least(types_col, n), "n_multi")


def water_after_level(docs: DataFrame, low: int = 30, high: int = 100,
                      types_col: str = "tipos", level_path: str = "evolucao.condicao.level",
                      pattern: str = WATER_PATTERN) -> DataFrame:
    """Query (b): documents of a type matching ``pattern`` whose evolution
    level is in (low, high], sorted by number."""
    pred = any_element_matches(types_col, pattern) & in_range(level_path, low, high)
    return find_sorted(docs, pred, {"numero": "numero", "nome": "nome", "level": level_path},
                       "numero", ["nome"])

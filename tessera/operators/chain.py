"""Ordered walks over chains stored one element per row.

A chain is ``(chain_id, pos)`` with ``pos`` the 0-based list index, as the
source lists are. Neither operator uses a window partitioned by chain: a
single chain may hold a large share of all rows, and a window would sort it
in one task. W1 is a self equi-join on ``(chain, pos + 1)`` -- a composite key
that spreads a hot chain over all partitions. W2 aggregates one number per
chain (map-side partial), writes it as a table and joins it back: Spark's
skew-join rule splits a hot chain only where both sides of the join are plain
shuffles, which an aggregate under the join is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def pair_with_next(df: DataFrame, chain: str, pos: str, carry: list[str],
                   prefix: str = "next_") -> DataFrame:
    """Entries are the even positions; each takes the fields of the
    following odd position as its connector (NULL for a trailing entry)."""
    entries = df.where(F.col(pos) % 2 == 0).select(chain, pos, *carry)
    connectors = df.where(F.col(pos) % 2 == 1).select(
        F.col(chain).alias("_c"), (F.col(pos) - 1).alias("_p"),
        *[F.col(c).alias(prefix + c) for c in carry])
    cond = (F.col(chain) == F.col("_c")) & (F.col(pos) == F.col("_p"))
    return entries.join(connectors, cond, "left").drop("_c", "_p")


def successors_after_first_match(df: DataFrame, chain: str, pos: str,
                                 match: Column) -> DataFrame:
    """All entries strictly after the first entry that matches; a chain
    without a match contributes nothing."""
    firsts = (df.groupBy(F.col(chain).alias("_c"))
              .agg(F.min(F.when(match, F.col(pos))).alias("_first"))
              .where(F.col("_first").isNotNull()))
    joined = df.join(materialize(firsts, "chain-firsts"), F.col(chain) == F.col("_c"), "inner")
    return joined.where(F.col(pos) > F.col("_first")).drop("_c", "_first")


def name_equals(c: Column, name) -> Column:
    """Trimmed, case-insensitive name equality used to locate the current entry."""
    from ..functions.scalars import ustrip
    other = F.lit(name) if isinstance(name, str) else name
    return F.lower(ustrip(c)) == F.lower(ustrip(other))

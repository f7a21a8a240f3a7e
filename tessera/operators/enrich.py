"""Fan-out / fan-in enrichment.

The source crawls: every listing row follows one link (J1), every item
requests one page per ability and collects the replies back into a list once
all have arrived (J2 + G4), with a constant description when a page is
missing. Here the pages are a table, so the same flow is explode -> left
equi-join -> group.

Join strategy is left to Catalyst/AQE: a side is broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (statistics at
plan time, actual shuffle sizes at run time with AQE). No hint forces a
broadcast of a table whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Description texts used when an ability page is missing or
# holds no description.
MISSING_PAGE_TEXT = "Falha ao obter descrição"
NO_DESCRIPTION_TEXT = "Descrição não encontrada"


def explode_list(df: DataFrame, list_col: str, pos: str = "pos", elem: str = "elem",
                 keep_empty: bool = True) -> DataFrame:
    """U4: one row per list element with its position; rows with an empty or
    NULL list survive once with NULL position when ``keep_empty``."""
    gen = F.posexplode_outer if keep_empty else F.posexplode
    others = [c for c in df.columns if c != list_col]
    return df.select(*others, gen(F.col(list_col)).alias(pos, elem))


def follow_links(links: DataFrame, pages: DataFrame, link_url: str, page_url: str) -> DataFrame:
    """Every link meets the page at its resolved URL (inner equi-join).
    The same page may be met by many links; nothing is deduplicated."""
    return links.join(pages, links[link_url] == pages[page_url], "inner")


def lookup_with_fallback(items: DataFrame, pages: DataFrame, item_key: str, page_key: str,
                         value_col: str, out_col: str, fallback: str = MISSING_PAGE_TEXT) -> DataFrame:
    """Left equi-join of fanned-out items to their pages; a missing page
    gives ``fallback``. Rows whose key is NULL (no list element) pass through
    with a NULL value."""
    p = pages.select(F.col(page_key).alias("_pk"), F.col(value_col).alias("_pv"))
    joined = items.join(p, items[item_key] == F.col("_pk"), "left")
    val = F.when(F.col(item_key).isNull(), F.lit(None).cast("string")) \
           .otherwise(F.coalesce(F.col("_pv"), F.lit(fallback)))
    return joined.withColumn(out_col, val).drop("_pk", "_pv")


def fan_in(df: DataFrame, group: list[str], pos: str, fields: list[str], out_col: str,
           chunk_size: int | None = None, chunk_col: str = "chunk") -> DataFrame:
    """Collect the element rows of each group back into one list ordered
    by ``pos`` (then by the fields, so ties are deterministic). Rows with NULL
    ``pos`` (an item with no elements) give an empty list.

    The list size is the group's own fan-out; ``collect_list`` runs with a
    map-side partial aggregate, so the shuffle carries per-partition partial
    lists rather than the joined rows. For groups whose fan-out is not
    bounded, pass ``chunk_size``: the list is emitted as consecutive rows
    ``(group, chunk, list)`` of at most ``chunk_size`` elements (chunk = pos
    div chunk_size), so no task ever holds more than one chunk of a group;
    concatenating the chunks in order gives the whole list.
    """
    elem = F.struct(F.col(pos).alias("_pos"), *[F.col(f) for f in fields])
    coll = F.array_sort(F.collect_list(F.when(F.col(pos).isNotNull(), elem)))
    strip = F.transform(coll, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    if chunk_size is None:
        return df.groupBy(*group).agg(strip.alias(out_col))
    chunk = F.coalesce(F.floor(F.col(pos) / chunk_size), F.lit(0)).cast("bigint").alias(chunk_col)
    return df.groupBy(*group, chunk).agg(strip.alias(out_col))

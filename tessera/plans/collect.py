"""Trace A: pages -> raw items, as Spark operators over parsed pages.

1. every page is parsed once (``sources.pages.parse_pages``, narrow) and the
   result is written as a table in the shared checkpoint folder -- it feeds
   three joins and is the costliest step to recompute after an executor loss;
2. listing rows with a link are resolved against the listing URL (X1, F1,
   T15) and meet their detail page (J1, equi-join on URL);
3. per link, the vitals table whose label matches the form hint is chosen,
   else the first (J4/O3 as an array filter -- tables of one page, no shuffle);
4. the effectiveness map (M1) and the following evolutions (W1 pairing, W2
   successors) are array expressions over the page's own lists;
5. abilities fan out (M9 zip of names and links), meet their pages with a
   fallback text for missing pages (J2, left join) and fan back in ordered by
   position (G4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import scalars as S
from ..operators import enrich
from ..sources.pages import parse_pages


def _choose_table(vitals: Column, hint: Column) -> Column:
    """First table whose label matches the hint, else the first table."""
    matched = F.filter(vitals, lambda t: S.label_match(t["label"], hint))
    return F.coalesce(F.get(matched, 0), F.get(vitals, 0))


def _next_evolutions(evo: Column, page_url: Column, current: Column, incoming: bool = False,
                     per_chain: bool = False) -> Column:
    """W1 + W2 over one page's card list (cards at even positions, each
    followed by its connector).

    Defaults reproduce the source: all chain lists of a page are concatenated
    before pairing (H6) and an entry's level is the connector *after* it
    (H5). ``per_chain`` pairs within each list; ``incoming`` takes the
    connector *before* the entry instead.
    """
    if per_chain:
        # positions restart in every chain list: pair by (chain, index in chain)
        evo = F.flatten(F.transform(
            F.array_distinct(F.transform(evo, lambda e: e["chain"])),
            lambda ch: F.transform(F.filter(evo, lambda e: e["chain"] == ch),
                                   lambda e, i: e.withField("pos", i))))
    n = F.size(evo)
    idx = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                   lambda i: (F.get(evo, i)["pos"] % 2 == 0) & (i < n))
    conn = (lambda i: F.when(F.get(evo, i - 1)["chain"] == F.get(evo, i)["chain"], F.get(evo, i - 1))) \
        if incoming else \
        (lambda i: F.when(F.get(evo, i + 1)["chain"] == F.get(evo, i)["chain"], F.get(evo, i + 1))
         if per_chain else F.get(evo, i + 1))
    steps = F.when(n > 0, F.transform(idx, lambda i: F.struct(
        F.get(evo, i)["small"].alias("numero"),
        F.get(evo, i)["nome"].alias("nome"),
        F.when(F.get(evo, i)["href"].isNotNull() & (F.get(evo, i)["href"] != ""),
               S.resolve_url(page_url, F.get(evo, i)["href"])).alias("url"),
        F.when(F.coalesce(conn(i)["small"], F.lit("")) != "",
               S.strip_parens(conn(i)["small"])).alias("level"))))
    steps = F.coalesce(steps, F.array().cast(
        "array<struct<numero:string,nome:string,url:string,level:string>>"))
    norm = lambda x: F.lower(S.ustrip(x))
    rec = lambda s: F.struct(s["numero"].alias("numero"), s["level"].alias("level"),
                             F.lit(None).cast("string").alias("item"), s["nome"].alias("nome"),
                             s["url"].alias("url"))
    none = F.array().cast("array<struct<numero:string,level:string,item:string,nome:string,url:string>>")

    def successors(st):
        hits = F.filter(F.transform(st, lambda s, i: F.when(
            (F.coalesce(s["nome"], F.lit("")) != "") & (F.coalesce(current, F.lit("")) != "")
            & (norm(s["nome"]) == norm(current)), i)), lambda x: x.isNotNull())
        # the first hit is bound once, not re-derived for every element
        return S.let(F.get(hits, 0), lambda first: F.when(first.isNull(), none).otherwise(F.transform(
            F.filter(F.transform(st, lambda s, i: F.when(i > first, s)), lambda x: x.isNotNull()), rec)))

    return S.let(steps, successors)


def collect_items(pages: DataFrame, listing_url: str | None = None, checkpoint: bool = True,
                  incoming_level: bool = False, per_chain: bool = False,
                  listing: Column | None = None, listing_order: Column | None = None) -> DataFrame:
    """Raw items (typed nested columns) for every linked row of the listing.

    The listing is one page (``listing_url``, as in the source) or a set of
    pages selected by the predicate ``listing`` (a paginated listing keeps
    every page bounded). ``seq`` numbers the rows of all listing pages in
    order of (``listing_order``, URL, row position), pages without an order
    last; an item is known by its listing page and position throughout, so
    equal or missing orders never mix items. A URL that was crawled several
    times counts once as an ability page (least description).
    ``incoming_level`` / ``per_chain``: see ``_next_evolutions`` (H5, H6)."""
    if (listing_url is None) == (listing is None):
        raise ValueError("give either listing_url or listing")
    parsed = parse_pages(pages)
    if checkpoint:
        # Written once as a table in the shared checkpoint folder: one parse
        # pass (an RDD checkpoint would parse twice), lineage cut for retries.
        from ..session import materialize
        parsed = materialize(parsed, "parsed-pages")

    is_listing = listing if listing is not None else (F.col("url") == listing_url)
    order = F.lit(0) if listing_order is None else listing_order
    listings = parsed.where(is_listing).select(F.col("url").alias("listing_url"), order.cast("bigint").alias("_page"),
                                               "listing")
    # One row per listing page goes through the window that numbers them.
    before = (Window.orderBy(F.col("_page").isNull(), "_page", "listing_url")
              .rowsBetween(Window.unboundedPreceding, -1))
    size = F.coalesce(F.array_max(F.transform("listing", lambda r: r["pos"])) + 1, F.lit(0))
    pages_before = (listings.select("listing_url", "_page", size.alias("_n"))
                    .groupBy("listing_url").agg(F.min("_page").alias("_page"), F.max("_n").alias("_n"))
                    .select("listing_url", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    rows = (listings.select("listing_url", F.explode("listing").alias("row")).join(pages_before, "listing_url"))
    links = rows.where(F.col("row.href").isNotNull() & (F.col("row.href") != "")).select(
        (F.col("_first") + F.col("row.pos")).cast("bigint").alias("seq"),
        F.col("row.form_hint").alias("form_hint"),
        S.fetch_url(F.col("listing_url"), F.col("row.href")).alias("target"))

    details = enrich.follow_links(links, parsed, "target", "url")
    # the chosen table is a column of its own so its six uses read it once
    details = details.withColumn("_table", _choose_table(F.col("vitals"), F.col("form_hint")))
    chosen = F.col("_table")
    items = details.select(
        "seq", "url",
        F.coalesce(chosen["numero"], F.lit("")).alias("numero"),
        F.col("h1").alias("nome"),
        F.coalesce(chosen["tamanho"], F.lit("")).alias("tamanho"),
        F.coalesce(chosen["peso"], F.lit("")).alias("peso"),
        F.coalesce(F.array_join(chosen["tipos"], ", "), F.lit("")).alias("tipos"),
        N.map_from_lists(F.col("eff_types"), F.col("eff_cells")).alias("efetividade"),
        _next_evolutions(F.col("evo"), F.col("url"), F.col("h1"), incoming_level, per_chain)
        .alias("proximas_evolucoes"),
        N.zip_shortest(F.coalesce(chosen["hab_nomes"], F.array().cast("array<string>")),
                       F.coalesce(chosen["hab_hrefs"], F.array().cast("array<string>")),
                       ("nome", "href")).alias("_habs"))

    # J2 + G4: one row per ability, its page's description, back to one list.
    fanned = items.select("seq", "url", F.posexplode_outer("_habs").alias("hpos", "h")).select(
        "seq", "hpos", S.ustrip(F.coalesce(F.col("h.nome"), F.lit(""))).alias("hab_nome"),
        F.when(F.col("h.href").isNotNull(), S.fetch_url(F.col("url"), F.col("h.href"))).alias("hab_url"))
    ability_pages = parsed.select(F.col("url").alias("ab_url"), S.first_nonempty(
        *[S.collapse_ws(F.get("desc", i)) for i in range(4)],
        default=enrich.NO_DESCRIPTION_TEXT).alias("descricao")) \
        .groupBy("ab_url").agg(F.min("descricao").alias("descricao"))      # one reply per request
    described = enrich.lookup_with_fallback(fanned, ability_pages, "hab_url", "ab_url", "descricao", "descricao")
    habilidades = enrich.fan_in(described.withColumnRenamed("hab_url", "url")
                                .withColumnRenamed("hab_nome", "nome"),
                                ["seq"], "hpos", ["url", "nome", "descricao"], "habilidades")
    return items.drop("_habs").join(habilidades, "seq", "left").select(
        "seq", "numero", "url", "nome", "proximas_evolucoes", "tamanho", "peso", "tipos", "efetividade",
        F.coalesce("habilidades", F.array().cast(
            "array<struct<url:string,nome:string,descricao:string>>")).alias("habilidades"))


def items_as_raw_text(items: DataFrame) -> DataFrame:
    """K4: the item feed as all-text columns (lists and maps as JSON
    literals), the shape the cleaning stage reads."""
    return items.select(*[F.to_json(c).alias(c) if c in ("proximas_evolucoes", "efetividade", "habilidades")
                          else F.col(c) for c in items.columns])

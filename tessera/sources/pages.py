"""Page extraction (X1-X6) as one Arrow-batched pass over a page table.

Each page is parsed once (stdlib ``html.parser``; malformed markup with
unclosed ``<p>``/``<b>`` is tolerated) and reduced to raw candidates only:
listing rows, every vitals table with its label, the effectiveness header and
cell texts, the ordered evolution card list, and the four description
candidates of an ability page. Choosing among candidates, pairing, joining
and fan-in are Spark operators downstream (``plans.collect``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The page structure the extractors look for (ids, classes,
# row header labels, section headings, containers, default hint).
# ---------------------------------------------------------------------------
LISTING_TABLE_ID = "pokedex"
LISTING_NAME_CELL, LISTING_LINK, LISTING_HINT = "cell-name", "ent-name", "text-muted"
DEFAULT_FORM_HINT = "Base"
VITALS_TABLE = "vitals-table"
HEADER_NATIONAL = "National"                       # contained in the row header
HEADER_HEIGHT, HEADER_WEIGHT, HEADER_TYPE, HEADER_ABILITIES = "Height", "Weight", "Type", "Abilities"
EFFECT_TABLE_FIRST, EFFECT_TABLE = "type-table-pokedex", "type-table"
EFFECT_HEADINGS = ("Type defenses", "Damage taken")
EFFECT_TOTAL_CELL = "cell-total"
TYPE_SUFFIX = " type"
EVOLUTION_LIST, EVOLUTION_TYPE = "infocard-list-evo", "itype"
EFFECT_HEADING, GAME_DESCRIPTIONS_HEADING = "Effect", "Game descriptions"
MAIN_CONTAINERS, MAIN_DIV_ID = ("article", "main"), "main"
# ---------------------------------------------------------------------------

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
# Start tag -> open elements it closes implicitly (up to a scope boundary).
_IMPLIED_END = {"p": ({"p"}, set()), "li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}),
                "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_RAW_TEXT = {"script", "style"}
_XML_WS = re.compile(r"[ \t\r\n]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def elements(self):
        return [c for c in self.children if isinstance(c, Node)]


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in _IMPLIED_END:
            closes, scope = _IMPLIED_END[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                t = self.stack[i].tag
                if t in scope:
                    break
                if t in closes:
                    del self.stack[i:]
                    break
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse_html(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


# -- small selection helpers (descendant walks over the tree) ---------------
def descendants(n: Node):
    """Element descendants in document order (iterative: malformed pages can
    nest thousands of unclosed tags)."""
    stack = [iter(n.children)]
    while stack:
        c = next(stack[-1], None)
        if c is None:
            stack.pop()
        elif isinstance(c, Node):
            yield c
            stack.append(iter(c.children))


def texts(n: Node) -> list[str]:
    """Descendant text nodes in document order, skipping script/style."""
    out, stack = [], [iter(n.children)]
    while stack:
        c = next(stack[-1], None)
        if c is None:
            stack.pop()
        elif isinstance(c, Node):
            if c.tag not in _RAW_TEXT:
                stack.append(iter(c.children))
        else:
            out.append(c)
    return out


def own_texts(n: Node) -> list[str]:
    return [c for c in n.children if isinstance(c, str)]


def norm_space(s: str | None) -> str:
    return _XML_WS.sub(" ", s or "").strip(" \t\r\n")


def string_value(n: Node) -> str:
    return "".join(texts(n))


def has_class_token(n: Node, cls: str) -> bool:
    return cls in n.attrs.get("class", "").split()


def class_contains(n: Node, part: str) -> bool:
    return part in n.attrs.get("class", "")


def first(it):
    return next(iter(it), None)


def preceding_sibling(n: Node, tag: str) -> Node | None:
    if n.parent is None:
        return None
    sibs = n.parent.elements()
    for s in reversed(sibs[:sibs.index(n)]):
        if s.tag == tag:
            return s
    return None


def following_siblings(n: Node) -> list[Node]:
    sibs = n.parent.elements()
    return sibs[sibs.index(n) + 1:]


def rows_with_header(table: Node, pred) -> list[Node]:
    return [tr for tr in descendants(table) if tr.tag == "tr"
            and any(th.tag == "th" and pred(norm_space(string_value(th))) for th in tr.elements())]


def first_own_text(nodes) -> str | None:
    for n in nodes:
        t = own_texts(n)
        if t:
            return t[0]
    return None


# -- extractors -------------------------------------------------------------
def listing_rows(root: Node) -> list[dict]:
    """Rows of the listing table: link and form hint (default Base)."""
    out = []
    table = first(t for t in descendants(root) if t.tag == "table" and t.attrs.get("id") == LISTING_TABLE_ID)
    if table is None:
        return out
    trs = [tr for tb in descendants(table) if tb.tag == "tbody" for tr in descendants(tb) if tr.tag == "tr"]
    for pos, tr in enumerate(trs):
        cells = [td for td in descendants(tr) if td.tag == "td" and has_class_token(td, LISTING_NAME_CELL)]
        a = first(x for td in cells for x in descendants(td) if x.tag == "a" and has_class_token(x, LISTING_LINK)
                  and "href" in x.attrs)
        hint = first_own_text(x for td in cells for x in descendants(td)
                              if x.tag == "small" and has_class_token(x, LISTING_HINT))
        out.append({"pos": pos, "href": a.attrs["href"] if a is not None else None,
                    "form_hint": (hint or DEFAULT_FORM_HINT).strip()})
    return out


def _vitals_table(t: Node, pos: int) -> dict:
    h2 = preceding_sibling(t, "h2")
    small = h2 and first_own_text(x for x in descendants(h2) if x.tag == "small")
    h2txt = h2 and first(own_texts(h2))
    label = (norm_space(small) or norm_space(h2txt) or "").strip()

    def cell_texts(header_pred, path_tag=None, attr=None):
        vals = []
        for tr in rows_with_header(t, header_pred):
            for td in (c for c in tr.elements() if c.tag == "td"):
                if path_tag is None:
                    vals.extend(own_texts(td))
                else:
                    for x in descendants(td):
                        if x.tag == path_tag:
                            if attr:
                                if attr in x.attrs:
                                    vals.append(x.attrs[attr])
                            else:
                                vals.extend(own_texts(x))
        return vals

    nat = cell_texts(lambda s: HEADER_NATIONAL in s, "strong")
    return {
        "pos": pos, "label": label,
        "numero": (nat[0] if nat else "").strip(),
        "tamanho": (first(cell_texts(lambda s: s == HEADER_HEIGHT)) or "").strip(),
        "peso": (first(cell_texts(lambda s: s == HEADER_WEIGHT)) or "").strip(),
        "tipos": [x.strip() for x in cell_texts(lambda s: s == HEADER_TYPE, "a")],
        "hab_nomes": cell_texts(lambda s: s == HEADER_ABILITIES, "a"),
        "hab_hrefs": cell_texts(lambda s: s == HEADER_ABILITIES, "a", "href"),
    }


def vitals_tables(root: Node) -> list[dict]:
    """X2 + X3: every vitals table that has a 'National' row, with its label."""
    tables = [t for t in descendants(root) if t.tag == "table" and class_contains(t, VITALS_TABLE)
              and rows_with_header(t, lambda s: HEADER_NATIONAL in s)]
    return [_vitals_table(t, i) for i, t in enumerate(tables)]


def _effectiveness_table(root: Node) -> Node | None:
    tables = [t for t in descendants(root) if t.tag == "table"]
    t = first(x for x in tables if class_contains(x, EFFECT_TABLE_FIRST))
    if t is not None:
        return t
    for h2 in (x for x in descendants(root) if x.tag == "h2"):
        s = string_value(h2)
        if any(h in s for h in EFFECT_HEADINGS):
            for sib in following_siblings(h2):
                if sib.tag == "div":
                    t = first(x for x in descendants(sib) if x.tag == "table" and class_contains(x, EFFECT_TABLE))
                    if t is not None:
                        return t
    return first(x for x in tables if class_contains(x, EFFECT_TABLE))


def effectiveness(root: Node) -> tuple[list[str], list[str]]:
    """Header type names (T18 applied) and first-row cell texts."""
    t = _effectiveness_table(root)
    if t is None:
        return [], []
    keep = lambda th: th.tag == "th" and not class_contains(th, EFFECT_TOTAL_CELL)
    heads = [th for th in descendants(t) if th.tag == "thead" for th in descendants(th) if keep(th)]
    if not heads:
        first_trs = [tr for tr in descendants(t) if tr.tag == "tr"
                     and tr is first(x for x in tr.parent.elements() if x.tag == "tr")]
        heads = [th for tr in first_trs for th in tr.elements() if keep(th)]
    names = []
    for th in heads:
        a = [x for x in th.elements() if x.tag == "a"]
        img = [x for x in th.elements() if x.tag == "img"]
        name = norm_space(first(tx for x in a for tx in own_texts(x)))
        name = name or norm_space(first(x.attrs["title"] for x in a if "title" in x.attrs))
        name = name or norm_space(first(x.attrs["alt"] for x in img if "alt" in x.attrs))
        name = name.replace(TYPE_SUFFIX, "").strip() if name else name
        if name:
            names.append(name)
    body_first = [tr for tb in descendants(t) if tb.tag == "tbody"
                  for tr in [first(x for x in tb.elements() if x.tag == "tr")] if tr is not None]
    cells = [td for tr in body_first for td in tr.elements() if td.tag == "td"]
    if not cells:
        second = [tr for tr in descendants(t) if tr.tag == "tr"
                  and [x for x in tr.parent.elements() if x.tag == "tr"].index(tr) == 1]
        cells = [td for tr in second for td in tr.elements() if td.tag == "td"]
    return names, [norm_space(first(own_texts(td))) for td in cells]


def evolution_cards(root: Node) -> list[dict]:
    """The alternating card/connector list of every evolution container."""
    out = []
    items = [(chain, c) for chain, d in enumerate(
        x for x in descendants(root) if x.tag == "div" and has_class_token(x, EVOLUTION_LIST))
        for c in d.elements()]
    for pos, (chain, c) in enumerate(items):
        name_a = [x for x in descendants(c) if x.tag == "a" and has_class_token(x, LISTING_LINK)]
        smalls = [x for x in descendants(c) if x.tag == "small"]
        out.append({
            "pos": pos, "chain": chain,
            "nome": first_own_text(name_a),
            "href": first(x.attrs["href"] for x in name_a if "href" in x.attrs),
            "small": first_own_text(smalls),
            "tipos": [tx for s in smalls for x in descendants(s) if x.tag == "a" and has_class_token(x, EVOLUTION_TYPE)
                      for tx in own_texts(x)],
        })
    return out


def description_candidates(root: Node) -> list[str]:
    """Effect section paragraphs; first paragraph after the effect
    heading; first paragraph of the main content; first game-description
    cell. Texts of each candidate are joined with spaces (T8 applied later)."""
    effect = [h for h in descendants(root) if h.tag == "h2" and norm_space(string_value(h)) == EFFECT_HEADING]
    c1, c2 = [], []
    for h in effect:
        for sib in following_siblings(h):
            if sib.tag == "h2":
                break
            if sib.tag == "p":
                c1.extend(texts(sib))
    for h in effect:
        p = first(s for s in following_siblings(h) if s.tag == "p")
        if p is not None:
            c2 = texts(p)
            break
    main = [n for n in descendants(root) if n.tag in MAIN_CONTAINERS
            or (n.tag == "div" and n.attrs.get("id") == MAIN_DIV_ID)]
    ps = [p for m in main for p in descendants(m) if p.tag == "p"]
    order = {id(n): i for i, n in enumerate(descendants(root))}
    c3 = texts(min(ps, key=lambda p: order[id(p)])) if ps else []
    c4 = []
    for h in (x for x in descendants(root) if x.tag == "h2" and GAME_DESCRIPTIONS_HEADING in string_value(x)):
        for sib in following_siblings(h):
            for t in (x for x in descendants(sib) if x.tag == "table" and class_contains(x, VITALS_TABLE)):
                tds = [td for tr in descendants(t) if tr.tag == "tr"
                       and tr is first(x for x in tr.parent.elements() if x.tag == "tr")
                       for td in tr.elements() if td.tag == "td"]
                if tds:
                    c4 = texts(tds[0])
                    break
            if c4:
                break
        if c4:
            break
    return [" ".join(c) for c in (c1, c2, c3, c4)]


def first_h1_text(root: Node) -> str:
    h1 = first(x for x in descendants(root) if x.tag == "h1")
    return ((first(own_texts(h1)) if h1 is not None else None) or "").strip()


_STR_ARR = T.ArrayType(T.StringType())
PARSED_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("h1", T.StringType()),
    T.StructField("listing", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()),
        T.StructField("form_hint", T.StringType())]))),
    T.StructField("vitals", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("numero", T.StringType()), T.StructField("tamanho", T.StringType()),
        T.StructField("peso", T.StringType()), T.StructField("tipos", _STR_ARR),
        T.StructField("hab_nomes", _STR_ARR), T.StructField("hab_hrefs", _STR_ARR)]))),
    T.StructField("eff_types", _STR_ARR),
    T.StructField("eff_cells", _STR_ARR),
    T.StructField("evo", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("chain", T.IntegerType()),
        T.StructField("nome", T.StringType()),
        T.StructField("href", T.StringType()), T.StructField("small", T.StringType()),
        T.StructField("tipos", _STR_ARR)]))),
    T.StructField("desc", _STR_ARR),
])


def _parse_batches(keep: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for url, html in zip(pdf["url"], pdf["html"]):
                root = parse_html(html)
                types, cells = effectiveness(root)
                out.append({"url": url, "h1": first_h1_text(root), "listing": listing_rows(root),
                            "vitals": vitals_tables(root), "eff_types": types, "eff_cells": cells,
                            "evo": evolution_cards(root), "desc": description_candidates(root)})
            res = pd.DataFrame(out, columns=[f.name for f in PARSED_SCHEMA.fields])
            for k in keep:
                res[k] = pdf[k].values
            yield res
    return run


def parse_pages(pages: DataFrame, url: str = "url", html: str = "html",
                keep: list[str] | None = None) -> DataFrame:
    """X1-X6 raw candidates, one row per page (narrow: no shuffle); columns
    in ``keep`` are passed through."""
    keep = list(keep or [])
    schema = T.StructType(list(PARSED_SCHEMA.fields) + [pages.schema[k] for k in keep])
    src = pages.select(pages[url].alias("url"), pages[html].alias("html"), *keep)
    return src.mapInPandas(_parse_batches(keep), schema)

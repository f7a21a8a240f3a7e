"""Array, map and struct helpers (M1-M9, G5, G7, G8, F7, F8) as Column expressions.

Legacy inputs carry lists and maps as Python-literal text. They are decoded
with ``from_json`` (single quotes are accepted by the JSON reader) after the
bare literals ``None``/``True``/``False`` are rewritten in value position. A
record list is parsed once as ``array<struct>``; only when that fails (an
element is not a record) is it decoded element-wise -- first to
``array<string>`` (each element keeps its raw JSON text), then each record --
so one malformed element is skipped instead of nulling the whole list.

Higher-order-function lambdas are evaluated without common-subexpression
elimination, so every intermediate used more than once is bound once with
``scalars.let``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import scalars as S

# ---------------------------------------------------------------------------
# Record field and column names of the source's data.
# ---------------------------------------------------------------------------
EVOLUTION_FIELDS = ["numero", "level", "item", "nome", "url"]
EVOLUTION_COLUMNS = ["numero_evol", "level_evol", "item_evol", "nome_evol", "url_evol"]
HABILIDADE_FIELDS = ["nome", "url", "descricao"]
# ---------------------------------------------------------------------------

_JSON_OPTS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
    "mode": "PERMISSIVE",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# A literal as its quoted strings, the text between them, and stray quotes.
_TOKENS_RE = r"""(?s)'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++|['"]"""
_HEX_ESCAPE_RE = r"(?<!\\)((?:\\\\)*+)\\x([0-9A-Fa-f]{2})"


def py_literal_to_json(c) -> Column:
    """Rewrite a Python literal's bare ``None``/``True``/``False`` and its
    two-digit hex escapes to JSON. Quoted strings are told apart first, so no
    text inside a value is touched; blanks before a literal don't matter."""
    def bare(token: Column) -> Column:
        for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
            token = F.regexp_replace(token, rf"(?<![A-Za-z0-9_]){word}(?=\s*+[,\]}}])", json)
        return token

    def rewrite(s: Column) -> Column:
        tokens = F.transform(F.regexp_extract_all(s, F.lit(_TOKENS_RE), F.lit(0)),
                             lambda t: F.when(t.rlike("^['\"]."), t).otherwise(bare(t)))
        return F.when(s.rlike("None|True|False"), F.array_join(tokens, "")).otherwise(s)

    return S.let(F.regexp_replace(_c(c), _HEX_ESCAPE_RE, r"$1\\u00$2"), rewrite)


def empty_map(value_type: str = "double") -> Column:
    return F.create_map().cast(f"map<string,{value_type}>")


@S.memo_by_name
def decode_literal_map(c, value_fn=S.multiplier, value_type: str = "double", quotes_first: bool = False) -> Column:
    """M2: literal map text -> ``map<string, value_type>``; any failure -> {}.
    ``quotes_first`` (H4): see ``decode_record_list``.

    Values are converted by ``value_fn`` (T7 by default). For a repeated key
    the last value wins, as in a Python dict literal.
    """
    def decode(s):
        raw = F.from_json(py_literal_to_json(s), "map<string,string>", _JSON_OPTS)
        conv = S.let(raw, lambda m: F.transform_values(dedupe_keys_last(m), lambda k, v: value_fn(v)))
        return F.coalesce(F.when(s.rlike(r"^\s*\{"), conv), empty_map(value_type))

    return S.let(S.null_tokens(c, normalise_chars=quotes_first), decode)


def decode_record_list(c, fields: list[str], quotes_first: bool = False) -> Column:
    """F8: literal list of records -> ``array<struct<fields: string>>``.
    ``quotes_first`` (H4) makes typographic quotes straight before decoding, as
    the source does: one apostrophe inside a value then loses the list.

    NULL when the text is not a list or does not decode; elements that are
    not records are skipped.
    """
    struct_ddl = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"

    def decode(s):
        js = py_literal_to_json(s)

        def per_element(j):
            # Slow path: elements kept as raw JSON text, non-records skipped.
            elems = F.from_json(j, "array<string>", _JSON_OPTS)
            return F.transform(F.filter(elems, ustarts_with_brace),
                               lambda e: F.from_json(e, struct_ddl, _JSON_OPTS))

        # Fast path: one parse when every element is a record; a non-record
        # element makes it NULL and the element-wise decode takes over.
        def pick(j):
            direct = F.from_json(j, f"array<{struct_ddl}>", _JSON_OPTS)
            # a null element is not a record either ({} is: a struct of NULLs)
            return F.coalesce(F.filter(direct, lambda e: e.isNotNull()), per_element(j))

        return F.when(s.rlike(r"^\s*\["), S.let(js, pick))

    return S.let(S.null_tokens(c, normalise_chars=quotes_first), decode)


def _leaf(field: str, fn=None):
    """One-argument lambda reading ``field`` (Spark inspects lambda arity)."""
    if fn is None:
        return lambda e: e[field]
    return lambda e: fn(e[field])


def dedupe_keys_last(m) -> Column:
    """Keep the last entry of every repeated map key (Python dict semantics)."""
    ents = F.map_entries(_c(m))
    keys = F.map_keys(_c(m))
    n = F.greatest(F.size(ents), F.lit(1))
    last = F.filter(ents, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, n), e["key"]))
    return F.map_from_entries(last)


def ustarts_with_brace(e: Column) -> Column:
    return e.rlike(r"^\s*\{")


def text_or_placeholder(c) -> Column:
    """T1a on a leaf, with the text ``None`` as placeholder for no value."""
    return F.coalesce(S.null_tokens(c, True), F.lit(S.PLACEHOLDER))


@S.memo_by_name
def decode_records_joined(c, fields: list[str]) -> Column:
    """M3: literal record list -> struct of ``"; "``-joined texts, one per field.

    Missing/empty leaves print as ``None``; a text that is not a decodable list
    gives a struct of NULLs.
    """
    return S.let(decode_record_list(c, fields), lambda recs: F.struct(*[
        F.when(recs.isNotNull(),
               F.array_join(F.transform(recs, _leaf(f, text_or_placeholder)), S.JOIN_SEP))
        .alias(f) for f in fields]))




def _evolution_entry(num: Column, lvl: Column, item: Column, nome: Column, url: Column) -> Column:
    return F.struct(num.cast("string").alias("numero"), lvl.cast("string").alias("level"),
                    item.alias("item"), nome.alias("nome"), url.alias("url"))


def _split_bar_semicolon(s: Column) -> Column:
    return (F.when(s.contains(S.MULTI_SEP_FIRST), S.split_clean(s, "\\" + S.MULTI_SEP_FIRST))
            .when(s.contains(S.MULTI_SEP_SECOND), S.split_clean(s, S.MULTI_SEP_SECOND))
            .otherwise(F.array(s)))


@S.memo_by_name
def decode_evolutions(c) -> Column:
    """M4 + M5: evolution list text -> struct of five ``"; "``-joined columns.

    Preferred shape is a literal list of records; number and level are
    repaired when swapped, and entries with nothing usable are dropped. When
    the text is not such a list, or no entry survives, the text itself is
    split on ``|``/``;`` and each part classified as id/level/item/name/URL.
    Empty input gives five ``None`` texts. Every intermediate is bound once
    (``S.let``), so each regex runs once per element.
    """
    nt = lambda x: S.null_tokens(x, True)
    src = F.struct(nt(c).alias("s"), decode_record_list(c, EVOLUTION_FIELDS).alias("recs"))

    def repair(e):
        return F.struct(F.coalesce(S.dex_id_bound(e["n"]), S.dex_id_bound(e["l"])).alias("dex"),
                        F.coalesce(S.level_bound(e["l"]), S.level_bound(e["n"])).alias("lvl"),
                        e["item"], e["nome"], e["url"])

    def loose(p):
        return S.let(nt(p), lambda q: _evolution_entry(
            S.dex_id_bound(q), S.level_bound(q),
            F.when(S.is_item_token(p), p), F.when(S.is_name_token(p), p), F.when(S.is_url_token(p), p)))

    def columns(s, chosen):
        return F.struct(*[
            F.when(s.isNull() | (F.size(chosen) == 0), F.lit(S.PLACEHOLDER))
            .otherwise(F.array_join(F.transform(chosen, _leaf(f)), S.JOIN_SEP, S.PLACEHOLDER))
            .alias(col) for f, col in zip(EVOLUTION_FIELDS, EVOLUTION_COLUMNS)])

    def body(v):
        norm = F.transform(v["recs"], lambda r: F.struct(
            nt(r["numero"]).alias("n"), nt(r["level"]).alias("l"), nt(r["item"]).alias("item"),
            nt(r["nome"]).alias("nome"), nt(r["url"]).alias("url")))
        fixed = F.filter(F.transform(norm, repair),
                         lambda e: F.coalesce(e["dex"].cast("string"), e["lvl"].cast("string"),
                                              e["item"], e["nome"], e["url"]).isNotNull())
        pick = lambda fx: F.when(F.coalesce(F.size(fx), F.lit(0)) > 0, F.transform(fx, lambda e: _evolution_entry(
            e["dex"], e["lvl"], e["item"], e["nome"], e["url"]))) \
            .otherwise(F.transform(_split_bar_semicolon(v["s"]), loose))
        return S.let(fixed, lambda fx: S.let(pick(fx), lambda ch: columns(v["s"], ch)))

    return S.let(src, body)


def first_non_null(arr, fn=None) -> Column:
    """First non-NULL of ``transform(arr, fn)``; evaluated once per element."""
    a = _c(arr)
    if fn is not None:
        a = F.transform(a, fn)
    return F.get(F.filter(a, lambda x: x.isNotNull()), 0)


def drop_empty_records(arr, fields: list[str], normalise=None) -> Column:
    """drop list entries whose every field is empty (NULL or a null token)."""
    norm = normalise or (lambda x: S.null_tokens(x, False))
    return F.filter(_c(arr), lambda e: F.coalesce(*[norm(e[f]) for f in fields]).isNotNull())




@S.memo_by_name
def rebuild_records(nomes, urls, descricoes, strict: bool = False) -> Column:
    """M6: three delimited columns -> list of records, padded to the longest
    list with NULL; records whose three fields are all empty are dropped.

    By default a placeholder text (``None``) next to a real value survives in
    the record, as in the source (H8); ``strict=True`` turns it into NULL."""
    split = (lambda x: F.transform(S.split_multi(x), lambda v: S.null_tokens(v, False))) if strict \
        else S.split_multi
    lists = F.struct(*[split(x).alias(n) for x, n in zip((nomes, urls, descricoes), HABILIDADE_FIELDS)])
    empty = F.array().cast("array<struct<nome:string,url:string,descricao:string>>")

    def body(v):
        n = F.greatest(*[F.size(v[f]) for f in HABILIDADE_FIELDS])
        recs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(*[
            F.get(v[f], i).alias(f) for f in HABILIDADE_FIELDS]))
        return drop_empty_records(F.when(n > 0, recs).otherwise(empty), HABILIDADE_FIELDS)

    return S.let(lists, body)


@S.memo_by_name
def build_evolution(numero_evol, level_evol, item_evol, nome_evol, url_evol) -> Column:
    """M7: five delimited columns -> optional ``evolucao`` struct.

    Each field is the first usable value of its own list (G5). ``condicao``
    exists only when level or item exists; all fields absent -> NULL.
    """
    text = lambda x: S.null_tokens(x, False)
    firsts = F.struct(
        first_non_null(S.split_multi(numero_evol), lambda x: S.to_int(x, False)).alias("numero"),
        first_non_null(S.split_multi(level_evol),
                       lambda x: S.level_bound(S.null_tokens(x, False), strict=False)).alias("level"),
        first_non_null(S.split_multi(item_evol), text).alias("item"),
        first_non_null(S.split_multi(nome_evol), text).alias("nome"),
        first_non_null(S.split_multi(url_evol), text).alias("url"))

    def body(v):
        cond = F.when(v["level"].isNotNull() | v["item"].isNotNull(),
                      F.struct(v["level"].alias("level"), v["item"].alias("item")))
        evo = F.struct(v["numero"].alias("numero"), v["nome"].alias("nome"), v["url"].alias("url"),
                       cond.alias("condicao"))
        present = F.coalesce(v["numero"].cast("string"), v["level"].cast("string"),
                             v["item"], v["nome"], v["url"]).isNotNull()
        return F.when(present, evo)

    return S.let(firsts, body)


def map_from_lists(keys, cells, empty_value: str = "1") -> Column:
    """M1: map from parallel header and cell lists.

    Stops at the shorter list; an empty cell maps to ``empty_value``; for a
    repeated header the last cell wins; NULL headers are skipped.
    """
    k, v = _c(keys), _c(cells)
    n = F.least(F.size(k), F.size(v))
    ks = F.slice(k, 1, n)
    vs = F.transform(F.slice(v, 1, n),
                     lambda x: F.when(F.coalesce(S.ustrip(x), F.lit("")) == "", F.lit(empty_value))
                     .otherwise(x))
    pairs = F.transform(ks, lambda x, i: F.struct(x.alias("k"), F.get(vs, i).alias("v")))
    last = F.filter(pairs, lambda e, i: e["k"].isNotNull()
                    & ~F.array_contains(F.slice(ks, i + 2, F.greatest(n, F.lit(1))), e["k"]))
    return F.map_from_entries(last)


def zip_shortest(a, b, names=("a", "b")) -> Column:
    """M9: positional zip truncated at the shorter list."""
    x, y = _c(a), _c(b)
    n = F.least(F.size(x), F.size(y))
    idx = F.sequence(F.lit(0), n - 1)
    return F.when(n > 0, F.transform(idx, lambda i: F.struct(
        F.get(x, i).alias(names[0]), F.get(y, i).alias(names[1]))))\
        .otherwise(F.array().cast(f"array<struct<{names[0]}:string,{names[1]}:string>>"))


def longest(*arrays) -> Column:
    """The largest size among lists (NULL lists ignored)."""
    return F.greatest(*[F.size(_c(a)) for a in arrays])


def any_set(*cols) -> Column:
    """G7 ``any``: at least one value is non-NULL."""
    return F.coalesce(*[_c(x).cast("string") for x in cols]).isNotNull()


def all_unset(*cols) -> Column:
    """G7 ``all(x is None)``."""
    return ~any_set(*cols)

"""Scalar text/number normalisers as native Column expressions.

Every function takes and returns a ``Column`` and stays inside whole-stage
codegen: regular expressions, ``try_cast`` and conditionals only, no Python
UDF. Digits are matched as ``[0-9]`` and whitespace with ``(?U)`` so the
behaviour does not depend on the regex engine's Unicode defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source behaviour exactly.
# ---------------------------------------------------------------------------
# Text tokens that mean "no value" (compared after strip + lower-case).
NULL_TOKENS = ("", "none", "null", "nan")
# Characters rewritten before the token check in the cleaning stage:
# no-break space and thin space become a space; curly double quotes become
# a straight double quote; the right single curly quote becomes an apostrophe.
CHAR_FROM = "\u00a0\u2009\u201c\u201d\u2019"
CHAR_TO = "  \"\"'"
# Multiplier glyphs.
FRACTION_GLYPHS = {"½": 0.5, "¼": 0.25, "¾": 0.75}
# Upper bounds of the id and level ranges (lower bound is 1 for both).
MAX_DEX_ID = 2000
MAX_LEVEL = 100
# Label texts that a base/empty form hint accepts, and the hint texts that
# count as "base".
BASE_LABELS = ("", "base", "pokédex data")
BASE_HINTS = ("", "base")
# Label normalisation: replacements applied after lower-casing.
LABEL_REPLACEMENTS = (("forme", "form"), ("-", " "))
# Patterns (digits written [0-9]; (?U)/(?i) flags added where used).
FIRST_DIGITS_RE = r"([0-9]+)"
NUMBER_RE = r"([0-9]+[.,]?[0-9]*)"                 # first number, '.' or ',' decimal mark
METRES_RE = NUMBER_RE + r"\s*m\b"                  # case-insensitive
CENTIMETRES_RE = NUMBER_RE + r"\s*cm\b"            # case-insensitive
HASH_ID_RE = r"#\s*([0-9]{1,4})"
BARE_ID_RE = r"\b([0-9]{1,4})\b"
ID_REFUSE_WORD = "level"                           # text containing it has no bare id
LEVEL_TAG_RE = r"[Ll]evel[^0-9]*([0-9]+)"
LEVEL_STRICT_RE = r"\b([0-9]{1,3})\b"
LEVEL_LOOSE_RE = r"([0-9]+)"
LEVEL_REFUSE = ("#", "http")                       # text containing one has no plain level
URL_TOKEN_RE = r"https?://"
ITEM_WORDS = ("stone", "item")
NAME_LETTER_RE = r"[A-Za-z]"
# Separators and placeholder.
LIST_SEP_IN = ","                                   # comma lists (types)
LIST_SEP_OUT = ", "
MULTI_SEP_FIRST, MULTI_SEP_SECOND = "|", ";"        # multi-value split order
JOIN_SEP = "; "
PLACEHOLDER = "None"
PAREN_CHARS = "()"
TYPE_SUFFIX = " type"
# ---------------------------------------------------------------------------

# Fixed value: the characters with the Unicode property White_Space.
_WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                "\u2028\u2029\u202f\u205f\u3000")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def memo_by_name(fn):
    """Reuse the built expression when every argument is a plain value
    (column names, flags): Column expressions are immutable, and the heavy
    decoders take thousands of driver-to-JVM calls to build. Calls with
    Column arguments are built fresh."""
    cache: dict = {}

    def is_plain(a) -> bool:
        if isinstance(a, tuple):
            return all(is_plain(x) for x in a)
        return isinstance(a, (str, int, bool, type(None)))

    def wrapper(*args, **kw):
        if not all(is_plain(a) for a in (*args, *kw.values())):
            return fn(*args, **kw)
        key = (args, tuple(sorted(kw.items())))
        if key not in cache:
            cache[key] = fn(*args, **kw)
        return cache[key]

    wrapper.__wrapped__ = fn
    wrapper.__doc__ = fn.__doc__
    wrapper.__name__ = fn.__name__
    return wrapper


def ustrip(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(_WHITE_SPACE))


def null_tokens(c, normalise_chars: bool = True) -> Column:
    """T1a (``normalise_chars=True``) / T1b: strip and map null tokens to NULL.

    T1a first rewrites NBSP/thin space and curly quotes (cleaning stage);
    T1b only strips (loading stage). The text is referenced once, so the
    expression stays linear when nested in list lambdas.
    """
    s = _c(c).cast("string")
    if normalise_chars:
        s = F.translate(s, CHAR_FROM, CHAR_TO)
    s = ustrip(s)
    tokens = "|".join(t for t in NULL_TOKENS if t)
    # A null token becomes "" and "" becomes NULL.
    return F.nullif(F.regexp_replace(s, f"(?i)^({tokens})$", ""), F.lit(""))


def first_digits(c, normalise_chars: bool = True) -> Column:
    """The first run of ASCII digits, else NULL."""
    s = null_tokens(c, normalise_chars)
    return F.nullif(F.regexp_extract(s, FIRST_DIGITS_RE, 1), F.lit(""))


def to_int(c, normalise_chars: bool = True) -> Column:
    """First digits as BIGINT; values beyond int64 become NULL."""
    return first_digits(c, normalise_chars).try_cast("bigint")


@memo_by_name
def canonical_digits(c, normalise_chars: bool = True) -> Column:
    """T3 (cleaning stage): the first digit run as an exact, unbounded integer
    in canonical text form (leading zeros removed), so ids beyond int64 stay
    distinct keys; the load stage's ``to_int`` nulls those."""
    return F.regexp_replace(first_digits(c, normalise_chars), r"^0+(?=[0-9])", "")


@memo_by_name
def parse_decimal(c) -> Column:
    """T4: first number with an optional ``.``/``,`` decimal mark as DOUBLE.

    The sign is ignored and ``1,234.5`` reads as 1.234, as in the source.
    """
    s = null_tokens(c, True)
    num = F.nullif(F.regexp_extract(s, NUMBER_RE, 1), F.lit(""))
    return F.replace(num, F.lit(","), F.lit(".")).try_cast("double")


# Whole-string float shapes accepted by Python's float() (after ',' -> '.'):
# digit groups may be separated by single underscores.
_DIGITS = r"[0-9](_?[0-9])*"
_FLOAT_SHAPE = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INF_SHAPE = r"(?i)^[+-]?(inf|infinity)$"
_NAN_SHAPE = r"(?i)^[+-]?nan$"


def to_float(c, normalise_chars: bool = False) -> Column:
    """T5: whole string as DOUBLE (comma as decimal mark), else NULL.

    A shape guard keeps Spark-only literals such as ``1d`` from casting.
    """
    s = null_tokens(c, normalise_chars)
    s = F.replace(s, F.lit(","), F.lit("."))
    return (F.when(s.rlike(_FLOAT_SHAPE), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
            .when(s.rlike(_INF_SHAPE),
                  F.when(s.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
            .when(s.rlike(_NAN_SHAPE), F.lit(float("nan")))
            .otherwise(F.lit(None).cast("double")))


@memo_by_name
def length_to_cm(c) -> Column:
    """``<x> m`` -> x*100 rounded to 2 places; ``<x> cm`` -> x; bare -> T4."""
    s = null_tokens(c, True)
    metres = F.nullif(F.regexp_extract(s, "(?iU)" + METRES_RE, 1), F.lit(""))
    cents = F.nullif(F.regexp_extract(s, "(?iU)" + CENTIMETRES_RE, 1), F.lit(""))
    as_double = lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double")
    return (F.when(metres.isNotNull(), F.bround(as_double(metres) * 100, 2))
            .when(cents.isNotNull(), as_double(cents))
            .otherwise(parse_decimal(s)))


def multiplier(c) -> Column:
    """Fraction glyph -> its value, else whole-string float, else NULL."""
    s = null_tokens(c, True)
    glyph = F.create_map(*[x for k, v in FRACTION_GLYPHS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(glyph, s), to_float(s))


def collapse_ws(c) -> Column:
    """NBSP and every whitespace run -> one space, then strip."""
    return F.btrim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?U)\s+", " "))


def split_clean(c, sep_regex: str) -> Column:
    """Split on a regex, strip every part, drop empty parts."""
    parts = F.transform(F.split(_c(c), sep_regex), ustrip)
    return F.filter(parts, lambda p: p != F.lit(""))


def normalize_list(c) -> Column:
    """T9 (list form): comma list -> array of stripped non-empty entries; NULL -> []."""
    s = null_tokens(c, True)
    return F.coalesce(split_clean(s, LIST_SEP_IN), F.array().cast("array<string>"))


@memo_by_name
def normalize_list_text(c) -> Column:
    """T9 (text form): the same list re-joined with ``", "``; NULL -> ``""``."""
    return F.array_join(normalize_list(c), LIST_SEP_OUT)


def split_multi(c, normalise_chars: bool = False) -> Column:
    """Split on ``|`` if present, else on ``;``, else one element.

    Parts are stripped and empty parts dropped; NULL/null tokens give [].
    """
    def split(s):
        arr = (F.when(s.contains(MULTI_SEP_FIRST), split_clean(s, "\\" + MULTI_SEP_FIRST))
               .when(s.contains(MULTI_SEP_SECOND), split_clean(s, MULTI_SEP_SECOND))
               .otherwise(F.array(s)))
        return F.when(s.isNull(), F.array().cast("array<string>")).otherwise(arr)

    return let(null_tokens(c, normalise_chars), split)


def join_with_placeholder(arr) -> Column:
    """Join with ``"; "``; NULL entries print as ``None``."""
    return F.array_join(_c(arr), JOIN_SEP, PLACEHOLDER)


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn``, which may use it many
    times. Inside higher-order-function lambdas (which are evaluated without
    common-subexpression elimination) this keeps repeated references from
    re-evaluating the whole sub-expression."""
    return F.get(F.transform(F.array(value), fn), 0)


def _in_range(n: Column, lo: int, hi: int) -> Column:
    return F.when((n >= lo) & (n <= hi), n)


def _bounded_int(text: Column, lo: int, hi: int) -> Column:
    return let(text.try_cast("int"), lambda n: _in_range(n, lo, hi))


def dex_id(c, max_id: int = MAX_DEX_ID) -> Column:
    """Id from ``#n`` (1-4 digits) first; text mentioning "level" gives
    NULL; else a free-standing 1-4 digit number; valid range 1..max_id."""
    return dex_id_bound(null_tokens(c, True), max_id)


def dex_id_bound(s: Column, max_id: int = MAX_DEX_ID) -> Column:
    """T12 on an already normalised text, each regex evaluated once (for use
    inside list lambdas)."""
    parts = F.struct(F.regexp_extract(s, "(?U)" + HASH_ID_RE, 1).alias("h"),
                     F.regexp_extract(s, "(?U)" + BARE_ID_RE, 1).alias("b"),
                     F.lower(s).contains(ID_REFUSE_WORD).alias("lv"))
    return let(parts, lambda p: F.when(p["h"] != "", _bounded_int(p["h"], 1, max_id))
               .when(p["lv"], F.lit(None).cast("int"))
               .otherwise(_bounded_int(F.nullif(p["b"], F.lit("")), 1, max_id)))


def level_bound(s: Column, strict: bool = True, max_level: int = MAX_LEVEL) -> Column:
    """T13 on an already normalised text, each regex evaluated once."""
    plain_re = "(?U)" + LEVEL_STRICT_RE if strict else LEVEL_LOOSE_RE
    parts = F.struct(F.regexp_extract(s, LEVEL_TAG_RE, 1).alias("t"),
                     F.regexp_extract(s, plain_re, 1).alias("p"),
                     (s.contains(LEVEL_REFUSE[0]) | F.lower(s).contains(LEVEL_REFUSE[1])).alias("no"))
    return let(parts, lambda p: F.when(p["t"] != "", _bounded_int(p["t"], 1, max_level))
               .when(p["no"], F.lit(None).cast("int"))
               .otherwise(_bounded_int(F.nullif(p["p"], F.lit("")), 1, max_level)))


def level(c, strict: bool = True, max_level: int = MAX_LEVEL) -> Column:
    """``Level n`` first; text with ``#`` or ``http`` gives NULL; else a
    number (strict: a free-standing 1-3 digit one; loose: the first digits);
    valid range 1..max_level. Strict is the cleaning stage, loose the load."""
    return level_bound(null_tokens(c, strict), strict, max_level)


def _norm_label(c) -> Column:
    s = F.lower(F.coalesce(_c(c), F.lit("")))
    for old, new in LABEL_REPLACEMENTS:
        s = F.replace(s, F.lit(old), F.lit(new))
    return ustrip(s)


def label_match(label, hint) -> Column:
    """Does a table label match a form hint (see module docs)."""
    lab, hin = _norm_label(label), _norm_label(hint)
    return (F.when(hin.isin(*BASE_HINTS), lab.isin(*BASE_LABELS))
            .otherwise(lab.contains(hin) | hin.contains(lab)))


# RFC 3986, appendix B.
_URI_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def remove_dot_segments(path) -> Column:
    """RFC 3986 section 5.2.4 for an absolute path: ``.`` segments vanish,
    ``..`` removes the segment before it; a path ending in ``.``/``..`` keeps
    its trailing slash. A fold over the path's segments (no regex loop)."""
    p = _c(path)
    segs = F.slice(F.split(p, "/"), 2, F.greatest(F.size(F.split(p, "/")) - 1, F.lit(0)))
    init = F.array().cast("array<string>")
    stack = F.aggregate(segs, init, lambda acc, seg: (
        F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg)))))
    last = F.element_at(segs, -1)
    stack = F.when(last.isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.when(p.startswith("/") & p.rlike(r"(^|/)\.\.?(/|$)"),
                  F.concat(F.lit("/"), F.array_join(stack, "/"))).otherwise(p)


def resolve_url(base, ref) -> Column:
    """Resolve a reference against a page URL (RFC 3986 section 5.2.2,
    with dot-segment removal on the resolved path)."""
    b, r = _c(base), F.coalesce(_c(ref), F.lit(""))
    scheme = F.regexp_extract(b, _URI_RE, 2)
    authority = F.regexp_extract(b, _URI_RE, 4)
    path = F.regexp_extract(b, _URI_RE, 5)
    query = F.regexp_extract(b, _URI_RE, 6)
    origin = F.concat(scheme, F.lit("://"), authority)
    base_dir = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    def with_clean_path(rel_path):
        # split off query/fragment, normalise the path part, reattach
        pth = F.regexp_extract(rel_path, r"^([^?#]*)", 1)
        tail = F.regexp_extract(rel_path, r"^[^?#]*(.*)$", 1)
        return F.concat(origin, remove_dot_segments(pth), tail)

    return (F.when(r == "", b)
            .when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), r)
            .when(r.startswith("//"), F.concat(scheme, F.lit(":"), r))
            .when(r.startswith("/"), with_clean_path(r))
            .when(r.startswith("?"), F.concat(origin, path, r))
            .when(r.startswith("#"), F.concat(origin, path, query, r))
            .otherwise(with_clean_path(F.concat(base_dir, r))))


def fetch_url(base, href) -> Column:
    """The URL that a fetch of ``href`` asks for: blanks around the reference
    and its fragment don't count."""
    return F.regexp_replace(resolve_url(base, ustrip(href)), "#.*$", "")


def url_host(c) -> Column:
    """Authority part of an absolute URL (without user info and port)."""
    auth = F.regexp_extract(_c(c), _URI_RE, 4)
    return F.lower(F.regexp_replace(F.regexp_replace(auth, r"^.*@", ""), r":[0-9]*$", ""))


def strip_parens(c) -> Column:
    """Strip surrounding ``(`` / ``)`` characters."""
    return F.btrim(_c(c), F.lit(PAREN_CHARS))


def first_nonempty(*cols, default=None) -> Column:
    """First candidate that is neither NULL nor empty, else ``default``."""
    cands = [F.nullif(_c(x), F.lit("")) for x in cols]
    if default is not None:
        cands.append(F.lit(default))
    return F.coalesce(*cands)


def strip_type_suffix(c) -> Column:
    """Remove every `` type`` and strip."""
    return ustrip(F.replace(_c(c), F.lit(TYPE_SUFFIX), F.lit("")))


def is_url_token(c) -> Column:
    return _c(c).rlike(URL_TOKEN_RE)


def is_item_token(c) -> Column:
    low = F.lower(_c(c))
    return low.contains(ITEM_WORDS[0]) | low.contains(ITEM_WORDS[1])


def is_name_token(c) -> Column:
    """A name is neither a URL nor an item and holds an ASCII letter."""
    return ~is_url_token(c) & _c(c).rlike(NAME_LETTER_RE) & ~is_item_token(c)

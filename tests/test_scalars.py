"""Scalar normalisers (T1-T19) on hand-written edge fixtures."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S


def one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_null_tokens_clean_stage(spark):
    vals = ["", " None ", "NULL", "nan", " ", " x ", "“q”", "it’s", "Nan ", "nonesuch", None]
    assert one(spark, vals, lambda c: S.null_tokens(c, True)) == \
        [None, None, None, None, None, "x", '"q"', "it's", None, "nonesuch", None]


def test_null_tokens_load_stage_keeps_chars(spark):
    vals = ["“q”", " none", "a b "]
    assert one(spark, vals, lambda c: S.null_tokens(c, False)) == ["“q”", None, "a b"]


def test_first_digits_and_int(spark):
    vals = ["#0007", "", "abc", "7.0", "99999999999999999999", "x12y34", None]
    assert one(spark, vals, S.first_digits) == ["0007", None, None, "7", "99999999999999999999", "12", None]
    assert one(spark, vals, S.to_int) == [7, None, None, 7, None, 12, None]


def test_parse_decimal(spark):
    vals = ["9.0 kg", "9,5", "1,234.5", "-3", "kg", "12.", None]
    assert one(spark, vals, S.parse_decimal) == [9.0, 9.5, 1.234, 3.0, None, 12.0, None]


def test_to_float_whole_string(spark):
    vals = ["1,5", " 2 ", "1d", "1f", "abc", "1e3", "-inf", ".5", "1.2.3", "1_000.5", "1__0", "_1", "5."]
    assert one(spark, vals, S.to_float) == [1.5, 2.0, None, None, None, 1000.0, float("-inf"), 0.5, None,
                                           1000.5, None, None, 5.0]
    import math
    assert math.isnan(one(spark, ["-nan"], S.to_float)[0])


def test_length_to_cm(spark):
    vals = ["0.5 m", "50 cm", "50", "1,2 m", "1.7 M", "abc", "12mm", "2 m 30 cm", "", "0.125 m"]
    assert one(spark, vals, S.length_to_cm) == [50.0, 50.0, 50.0, 120.0, 170.0, None, 12.0, 200.0, None, 12.5]


def test_multiplier(spark):
    vals = ["½", "¼", "¾", "2", "0", "", "⅛", " 4 ", "1,5", None]
    assert one(spark, vals, S.multiplier) == [0.5, 0.25, 0.75, 2.0, 0.0, None, None, 4.0, 1.5, None]


def test_collapse_ws(spark):
    vals = ["  a \n\t b c  ", None, ""]
    assert one(spark, vals, S.collapse_ws) == ["a b c", "", ""]


def test_normalize_list(spark):
    vals = ["Water, Ice", " ,Water,, Ice , ", "", None, "Fire"]
    assert one(spark, vals, S.normalize_list_text) == ["Water, Ice", "Water, Ice", "", "", "Fire"]


def test_split_multi(spark):
    vals = ["a | b; c", "a; b ;", "single ", "", None, "None"]
    out = one(spark, vals, S.split_multi)
    assert out == [["a", "b; c"], ["a", "b"], ["single"], [], [], []]


def test_join_placeholder(spark):
    df = spark.createDataFrame([(["a", None, "b"],)], "a array<string>")
    assert df.select(S.join_with_placeholder("a")).first()[0] == "a; None; b"


def test_dex_id(spark):
    vals = ["#0007", "Level 26", "(Level 26)", "0051", "12345", "#2001", "# 12", "no 7 here", "#abc 15",
            "2000", "0", None]
    assert one(spark, vals, S.dex_id) == [7, None, None, 51, None, None, 12, 7, 15, 2000, None, None]


def test_level_strict_and_loose(spark):
    vals = ["Level 36", "level 0", "Level 101", "#0051", "http://x/30", "36", "1000", "x36y", "LEVEL 5"]
    assert one(spark, vals, lambda c: S.level(c, strict=True)) == \
        [36, None, None, None, None, 36, None, None, 5]
    assert one(spark, vals, lambda c: S.level(c, strict=False)) == \
        [36, None, None, None, None, 36, None, 36, 5]


def test_label_match(spark):
    df = spark.createDataFrame([
        ("Pokédex data", "Base"), ("", "base"), ("Attack Forme", "Attack Form"), ("Coastal Form", "coastal"),
        ("", "Mega"), ("Galarian Form", "Base"), ("Speed-Forme", "speed form")], "l string, h string")
    assert [r[0] for r in df.select(S.label_match("l", "h")).collect()] == \
        [True, True, True, True, True, False, True]


@pytest.mark.parametrize("base,ref,out", [
    ("https://h.example.org/a/b?x=1#f", "/item/a", "https://h.example.org/item/a"),
    ("https://h.example.org/a/b", "c", "https://h.example.org/a/c"),
    ("http://h/a", "//cdn/x", "http://cdn/x"),
    ("http://h/a/b", "?q=2", "http://h/a/b?q=2"),
    ("http://h/a/b?q=1", "#top", "http://h/a/b?q=1#top"),
    ("http://h", "x", "http://h/x"),
    ("http://h/p", "https://o/z", "https://o/z"),
    ("http://h/p", "", "http://h/p"),
    ("http://a/b/c/d;p?q", "../g", "http://a/b/g"),
    ("http://a/b/c/d;p?q", "./g", "http://a/b/c/g"),
    ("http://a/b/c/d;p?q", "../..", "http://a/"),
    ("http://a/b/c/d;p?q", "../../../g", "http://a/g"),
    ("http://a/b/c/d;p?q", "/./g", "http://a/g"),
    ("http://a/b/c/d;p?q", "g/./h/../i?x=1", "http://a/b/c/g/i?x=1"),
    ("http://a/b/c/d;p?q", "..", "http://a/b/"),
])
def test_resolve_url(spark, base, ref, out):
    df = spark.createDataFrame([(base, ref)], "b string, r string")
    assert df.select(S.resolve_url("b", "r")).first()[0] == out


def test_strip_helpers(spark):
    assert one(spark, ["(Level 16)", "((x))"], S.strip_parens) == ["Level 16", "x"]
    assert one(spark, ["Fire type ", " Water type"], S.strip_type_suffix) == ["Fire", "Water"]
    df = spark.createDataFrame([("", None, "b")], "a string, b string, c string")
    assert df.select(S.first_nonempty("a", "b", "c", default="z")).first()[0] == "b"
    assert df.select(S.first_nonempty("a", "b", default="z")).first()[0] == "z"


def test_token_classes(spark):
    df = spark.createDataFrame([("https://x/y",), ("Water Stone",), ("Beta",), ("#0008",), ("item x",)], "p string")
    got = [tuple(r) for r in df.select(S.is_url_token("p"), S.is_item_token("p"), S.is_name_token("p")).collect()]
    assert got == [(True, False, False), (False, True, False), (False, False, True),
                   (False, False, False), (False, True, False)]


def test_html_unescape(spark):
    from tessera.plans.catalogue import html_unescape
    df = spark.createDataFrame([("T &amp;lt; &#233;t&#xE9; &#X41;&#128512; &copy;&middot;&quot;",)], "s string")
    assert df.select(html_unescape(F.col("s"))).first()[0] == 'T &lt; été A😀 ©·"'


def test_strip_is_linear_in_blanks(spark):
    import time
    from pyspark.sql import functions as F
    from tessera.functions import scalars as S
    df = spark.createDataFrame([("  a" + " " * 1_000_000 + "b" + " " * 1_000_000 + "c \u2003",)], "s string").cache()
    df.count()
    start = time.time()
    assert df.select(F.length(S.ustrip("s"))).first()[0] == 2_000_003
    assert time.time() - start < 5


def test_entities(spark):
    from pyspark.sql import functions as F
    from tessera.plans.catalogue import html_unescape
    given = ["&eacute;t&#233;&#xE9;", "&#9999999; &#xD800; &#0;", "&#0000065;", "&amp;lt;", "&bogus; a & b", "&#99999999999999999999;", None]
    want = ["\u00e9t\u00e9\u00e9", "&#9999999; &#xD800; &#0;", "A", "&lt;", "&bogus; a & b", "&#99999999999999999999;", None]
    df = spark.createDataFrame(list(enumerate(given)), "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(html_unescape(F.col("s"))).collect()] == want

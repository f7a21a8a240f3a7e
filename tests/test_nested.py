"""Literal decoders and nested rebuilds (M1-M9, F7, F8, G5) on edge fixtures."""

from pyspark.sql import functions as F

from tessera.functions import nested as N
from tessera.functions import scalars as S


def col_of(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_decode_literal_map(spark):
    vals = ["{'Electric': '2', 'Fire': '½', 'Grass': '¼', 'Ice': '¾', 'Rock': '0', 'Bug': '', "
            "'X': '⅛', 'Fire': '1'}", "{'a': '1'", "", None, "['x']", "{'n': None, 'v': 0.25}"]
    out = col_of(spark, vals, N.decode_literal_map)
    assert out[0] == {"Electric": 2.0, "Fire": 1.0, "Grass": 0.25, "Ice": 0.75, "Rock": 0.0,
                      "Bug": None, "X": None}
    assert out[1:5] == [{}, {}, {}, {}]
    assert out[5] == {"n": None, "v": 0.25}


def test_decode_records_joined(spark):
    vals = ["[]", "{'nome': 'x'}", "[{'nome': 'A; B', 'url': 'u|v', 'descricao': 'it’s'}, 7, {'nome': None}]",
            "[{'nome': 'O\\'Neil', 'url': 'u', 'descricao': 'd'}]", "oops", None,
            "[{'nome': 'a'}, None, {}]"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [tuple(r) for r in df.orderBy("i").select(
        N.decode_records_joined("v", N.HABILIDADE_FIELDS).alias("r")).select("r.*").collect()]
    assert got == [("", "", ""), (None, None, None),
                   # decoded before the quote rewrite: the typographic apostrophe survives (H4)
                   ("A; B; None", "u|v; None", "it's; None"),
                   ("O'Neil", "u", "d"), (None, None, None), (None, None, None),
                   # None is not a record (skipped); {} is one with no values
                   ("a; None", "None; None", "None; None")]


def test_decode_evolutions(spark):
    vals = [
        "[{'numero': '#0001', 'level': 'Level 1', 'item': None, 'nome': 'A', 'url': 'u'}, "
        "{'numero': '#0000', 'level': 'Level 0', 'item': None, 'nome': 'B', 'url': None}, "
        "{'numero': '#2000', 'level': 'Level 100', 'nome': 'C'}, {'numero': '#2001', 'level': 'Level 101', 'nome': 'D'}]",
        "[{'numero': '(Level 26)', 'level': '#0051', 'item': None, 'nome': 'Beta', 'url': 'b'}]",
        "[{'numero': '#0133', 'level': 'Water Stone', 'item': None, 'nome': 'Vap', 'url': 'v'}]",
        "#0008; Level 36; Beta",
        "#0008 | https://x/y | Fire Stone",
        "[{'numero': None, 'level': None, 'item': None, 'nome': None, 'url': None}]",
        "",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [tuple(r) for r in df.orderBy("i").select(N.decode_evolutions("v").alias("e")).select("e.*").collect()]
    assert got[0] == ("1; None; 2000; None", "1; None; 100; None", "None; None; None; None",
                      "A; B; C; D", "u; None; None; None")
    assert got[1] == ("51", "26", "None", "Beta", "b")
    assert got[2] == ("133", "None", "None", "Vap", "v")
    assert got[3] == ("8; None; None", "None; 36; None", "None; None; None",
                      "None; Level 36; Beta", "None; None; None")
    assert got[4] == ("8; None; None", "None; None; None", "None; None; Fire Stone",
                      "None; None; None", "None; https://x/y; None")
    # no usable entry: the text itself is classified (it mentions 'item')
    assert got[5] == ("None", "None", vals[5], "None", "None")
    assert got[6] == ("None",) * 5


def test_rebuild_records(spark):
    df = spark.createDataFrame([("a; b; c", "u1 | u2", "None"), ("None; x", "None; y", "None; z"),
                                (None, None, None)], "n string, u string, d string")
    got = [r[0] for r in df.select(N.rebuild_records("n", "u", "d")).collect()]
    assert [tuple(x) for x in got[0]] == [("a", "u1", None), ("b", "u2", None), ("c", None, None)]
    assert [tuple(x) for x in got[1]] == [("x", "y", "z")]
    assert got[2] == []


def test_build_evolution(spark):
    df = spark.createDataFrame([("None; 8", "None; Level 36", "None", "None; Beta", "None; u"),
                                ("None", "None", "None", "None", "None"),
                                ("None", "None", "Water Stone", "None", "None")],
                               "a string, b string, c string, d string, e string")
    got = [r[0] for r in df.select(N.build_evolution("a", "b", "c", "d", "e")).collect()]
    assert got[0].asDict(recursive=True) == {"numero": 8, "nome": "Beta", "url": "u",
                                             "condicao": {"level": 36, "item": None}}
    assert got[1] is None
    assert got[2].asDict(recursive=True) == {"numero": None, "nome": None, "url": None,
                                             "condicao": {"level": None, "item": "Water Stone"}}


def test_map_from_lists(spark):
    df = spark.createDataFrame([(["Fire", "Water", "Fire"], ["2", "", "½", "9"]), (["A", "B", "C"], ["x"]),
                                ([], [])], "k array<string>, v array<string>")
    got = [r[0] for r in df.select(N.map_from_lists("k", "v")).collect()]
    assert got == [{"Fire": "½", "Water": "1"}, {"A": "x"}, {}]


def test_zip_and_first(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["1", "2"], ["x", "7", "y8"])],
                               "a array<string>, b array<string>, c array<string>")
    r = df.select(N.zip_shortest("a", "b").alias("z"), N.longest("a", "b").alias("n"),
                  N.first_non_null("c", lambda x: S.to_int(x)).alias("f")).first()
    assert [tuple(x) for x in r["z"]] == [("a", "1"), ("b", "2")]
    assert r["n"] == 3 and r["f"] == 7


def test_drop_empty_records(spark):
    df = spark.createDataFrame([([("None", None, ""), ("a", None, None)],)],
                               "r array<struct<nome:string,url:string,descricao:string>>")
    got = df.select(N.drop_empty_records("r", N.HABILIDADE_FIELDS)).first()[0]
    assert [tuple(x) for x in got] == [("a", None, None)]


def test_rebuild_records_strict_placeholder(spark):
    df = spark.createDataFrame([("a; b", "None; u2", "d1")], "n string, u string, d string")
    compat = df.select(N.rebuild_records("n", "u", "d")).first()[0]
    strict = df.select(N.rebuild_records("n", "u", "d", strict=True)).first()[0]
    assert [tuple(x) for x in compat] == [("a", "None", "d1"), ("b", "u2", None)]
    assert [tuple(x) for x in strict] == [("a", None, "d1"), ("b", "u2", None)]


def test_any_all_fields(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, 1)], "a string, b int")
    got = [tuple(r) for r in df.select(N.any_set("a", "b"), N.all_unset("a", "b")).collect()]
    assert got == [(False, True), (True, False), (True, False)]


def test_literal_words_inside_values_stay(spark):
    from pyspark.sql import functions as F
    from tessera.functions import nested as N
    text = ("{'a': 'Effects: None, or some', 'b':            None, 'c': 'It is: True, yes', 'd': 'x\\xa0y', "
            "'e': \"don't: False, no\", 'f': True}")
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(F.from_json(N.py_literal_to_json("s"), "map<string,string>", {"allowSingleQuotes": "true"}).alias("m")).first()["m"]
    assert got == {"a": "Effects: None, or some", "b": None, "c": "It is: True, yes", "d": "x\u00a0y",
                   "e": "don't: False, no", "f": "true"}


def test_quotes_first_loses_a_list_with_an_apostrophe(spark):
    from tessera.functions import nested as N
    df = spark.createDataFrame([("[{'nome': 'it\u2019s'}]",)], "s string")
    kept, lost = df.select(N.decode_record_list("s", ["nome"]), N.decode_record_list("s", ["nome"], quotes_first=True)).first()
    assert [r["nome"] for r in kept] == ["it\u2019s"] and not lost

"""Type tests on fields without a declared type."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import variant_docs as vd
from tessera.sources import snapshot

DOCS = ['{"n":35}', '{"n":"35"}', '{"n":null}', '{}', '{"n":35.5}', '{"n":1e2}', '{"n":[35]}', '{"n":{"a":35}}', '{"n":true}',
        '{"n":12345678901234567890}', 'no json', None, '{"a.b":1,"n":{"x y":40}}', '[1]']
KINDS = ["number", "text", "null", "missing", "number", "number", "list", "record", "boolean", "number", "missing",
         "missing", "record", "missing"]


@pytest.fixture(scope="module")
def docs(spark):
    return vd.parse_documents(spark.createDataFrame(list(enumerate(DOCS)), "i int, json string"), "json")


def test_types_presence_and_null(docs):
    got = docs.orderBy("i").select(vd.type_of("doc", "n"), vd.is_present("doc", "n"), vd.is_null("doc", "n")).collect()
    assert [r[0] for r in got] == KINDS
    assert [r[1] for r in got] == [k != "missing" for k in KINDS]
    assert [r[2] for r in got] == [k == "null" for k in KINDS]


def test_only_numbers_are_in_range(docs):
    got = docs.where(vd.number_in_range("doc", "n", 35, 100)).orderBy("i").select("i").collect()
    assert [r[0] for r in got] == [4, 5]                      # 35 is not above 35; "35" and [35] are no numbers
    got = docs.where(vd.number_in_range("doc", "n", 35, 100, low_inclusive=True, high_inclusive=False)).select("i").collect()
    assert sorted(r[0] for r in got) == [0, 4]
    assert [r[0] for r in docs.where(vd.number_in_range("doc", "n.x y", 0, 100)).select("i").collect()] == [12]


def test_patterns_meet_texts_and_lists(spark):
    rows = ['{"t":["Fire","WATER"]}', '{"t":"water"}', '{"t":[7,null,["water"]]}', '{"t":null}', '{}', '{"t":["watery"]}']
    docs = vd.parse_documents(spark.createDataFrame(list(enumerate(rows)), "i int, json string"), "json")
    got = docs.where(vd.text_element_matches("doc", "t", "(?iu)^water$")).select("i").collect()
    assert sorted(r[0] for r in got) == [0, 1]


def test_find_sorts_and_projects(docs):
    got = vd.find_documents(docs, "doc", vd.is_present("doc", "n"), {"n": ("n", "double"), "t": ("n", "string")}, ["n", "t"])
    assert [r["n"] for r in got.collect() if r["n"] is not None] == [35.0, 35.5, 100.0, 12345678901234567890.0]
    assert got.where("t IS NOT NULL").collect()[0]["t"] == "35"


def test_snapshots_keep_types_and_absent_fields(spark, docs, tmp_path):
    root = str(tmp_path / "c")
    snapshot.write_snapshot(docs, root)
    back = snapshot.read_snapshot(spark, root)
    assert [r[0] for r in back.orderBy("i").select(vd.type_of("doc", "n")).collect()] == KINDS
    text = {r["i"]: r["json"] for r in vd.as_text(back, "doc").collect()}
    assert text[2] == '{"n":null}' and text[3] == "{}" and text[11] is None


def test_counts_and_paths(docs):
    n = {(r["path"], r["type"]): r["n"] for r in vd.count_types(docs, "doc", ["n", "zz"]).collect()}
    assert n["n", "missing"] == KINDS.count("missing") and n["zz", "missing"] == len(DOCS)
    for bad in ("", "a..b", "a'b", "a]"):
        with pytest.raises(ValueError):
            vd.json_path(bad)


def test_an_empty_table(docs):
    assert docs.where("false").where(vd.number_in_range("doc", "n", 0, 1)).collect() == []
    assert docs.where(F.lit(False)).select(vd.type_of("doc", "n")).collect() == []

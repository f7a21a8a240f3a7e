"""The whole flow on invented raw rows (FIXTURES.md sections 1-3): CSV scan,
clean, CSV round trip, document build, load, both source queries."""

import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import lookup, merge
from tessera.plans import etl
from tessera.sources import csv_io

RAW = [
    # numero, url, nome, proximas_evolucoes, tamanho, peso, tipos, efetividade, habilidades, seq
    ["#0007", "https://h/7", "Aqualo",
     "[{'numero': '#0008', 'level': 'Level 16', 'item': None, 'nome': 'Aqualor', 'url': 'https://h/8'}, "
     "{'numero': '#0009', 'level': 'Level 36', 'item': None, 'nome': 'Aquamax', 'url': 'https://h/9'}]",
     "0.5 m", "9,0 kg", "Water", "{'Electric': '2', 'Fire': '½'}",
     "[{'url': 'https://h/a1', 'nome': 'Surge', 'descricao': 'Ups; water'}]", "0"],
    ["7.0", "https://h/dup", "Dup", "", "", "", "Fire", "", "", "1"],
    ["#0079", "https://h/79", "Lento",
     "[{'numero': '#0080', 'level': 'Level 37', 'item': None, 'nome': 'Lentor', 'url': 'https://h/80'}]",
     "120 cm", "36 kg", "Water, Psychic", "{'Grass': '2', 'Fire': '¼'}", "[]", "2"],
    ["", "", "Keyless", "", "", "", ", ÁGUA ,", "broken", "not a list", "3"],
    ["abc", "https://h/x", "NoDigits", "", "", "", "Water", "", "", "4"],
    ["#0001", "https://h/1", 'Verda "x"', "#0002 | Level 16 | Verdon", "0,7 m", "6,9 kg", "Grass, Poison", "",
     "[{'url': 'u', 'nome': 'Thicket', 'descricao': 'Line1\nLine2'}]", "5"],
    ["99999999999999999999", "https://h/huge", "Huge", "", "", "", "", "", "", "6"],
]


@pytest.fixture(scope="module")
def raw_csv():
    d = tempfile.mkdtemp(prefix="tessera-raw-")
    path = os.path.join(d, "items.csv")
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(etl.RAW_COLUMNS + ["seq"])
        for r in RAW:
            w.writerow(r)
        fh.write('"#0150","https://h/150"\n')   # short row: absent cells read as ""
    return path


def _raw(spark, path):
    df = csv_io.read_text_csv(spark, path, etl.RAW_COLUMNS + ["seq"])
    return df.withColumn("seq", F.coalesce(F.col("seq").try_cast("bigint"), F.lit(99)))


def _docs_by_name(docs):
    return {r["nome"]: r.asDict(recursive=True) for r in docs.collect()}


def test_raw_scan_reads_quotes_and_multiline(spark, raw_csv):
    rows = {r["seq"]: r for r in _raw(spark, raw_csv).collect()}
    assert rows[5]["nome"] == 'Verda "x"'
    assert "Line1\nLine2" in rows[5]["habilidades"]
    assert rows[99]["nome"] == "" and rows[99]["numero"] == "#0150"


def test_clean_dedup_keep_first(spark, raw_csv):
    clean = etl.clean_items(_raw(spark, raw_csv))
    got = {r["numero"]: r["nome"] for r in clean.collect()}
    # 7.0 duplicates #0007 (first kept); '' and 'abc' share the NULL key (first kept)
    assert got == {"7": "Aqualo", "79": "Lento", None: "Keyless", "1": 'Verda "x"',
                   "99999999999999999999": "Huge", "150": ""}
    row = {r["nome"]: r for r in clean.collect()}["Aqualo"]
    assert row["Peso_kg"] == 9.0 and row["altura_cm"] == 50.0
    assert row["efetividade_dict"] == {"Electric": 2.0, "Fire": 0.5}
    assert (row["numero_evol"], row["level_evol"], row["nome_evol"]) == ("8; 9", "16; 36", "Aqualor; Aquamax")
    assert row["habilidades_descricoes"] == "Ups; water"


def _check_documents(docs):
    d = _docs_by_name(docs)
    sq = d["Aqualo"]
    assert sq["numero"] == 7 and sq["tipos"] == ["Water"] and sq["peso_kg"] == 9.0 and sq["altura_cm"] == 50.0
    assert sq["efetividade"] == {"Electric": 2.0, "Fire": 0.5}
    # a ';' inside a description splits it again on load (source behaviour)
    assert sq["habilidades"] == [{"nome": "Surge", "url": "https://h/a1", "descricao": "Ups"},
                                 {"nome": None, "url": None, "descricao": "water"}]
    assert sq["evolucao"] == {"numero": 8, "nome": "Aqualor", "url": "https://h/8",
                              "condicao": {"level": 16, "item": None}}
    sp = d["Lento"]
    assert sp["tipos"] == ["Water", "Psychic"] and sp["altura_cm"] == 120.0 and sp["habilidades"] == []
    assert sp["evolucao"]["condicao"]["level"] == 37
    k = d["Keyless"]
    assert k["numero"] is None and k["url"] is None and k["tipos"] == ["ÁGUA"] and k["efetividade"] == {}
    assert k["evolucao"] is None and k["habilidades"] == []
    b = d['Verda "x"']
    assert b["altura_cm"] == 70.0 and b["peso_kg"] == 6.9
    assert b["habilidades"] == [{"nome": "Thicket", "url": "u", "descricao": "Line1\nLine2"}]
    assert b["evolucao"] == {"numero": 2, "nome": "Level 16", "url": None, "condicao": {"level": 16, "item": None}}
    assert d["Huge"]["numero"] is None   # beyond int64 at load


def test_documents_typed_path(spark, raw_csv):
    docs = etl.build_documents(etl.clean_items(_raw(spark, raw_csv)))
    _check_documents(docs)


def test_documents_via_clean_csv(spark, raw_csv):
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-clean-"), "clean")
    csv_io.write_csv(etl.clean_items(_raw(spark, raw_csv)), out)
    text = csv_io.read_text_csv(spark, out, [f.name for f in etl.CLEAN_SCHEMA.fields] + ["seq"])
    docs = etl.build_documents(text.withColumn("seq", F.col("seq").try_cast("bigint")))
    _check_documents(docs)


def test_load_and_queries(spark, raw_csv):
    docs = etl.build_documents(etl.clean_items(_raw(spark, raw_csv)))
    loaded = etl.load_collection(docs)
    c = merge.write_counters(loaded).first().asDict()
    # every document is new after the reset; Keyless and Huge (no usable id) go by name
    assert c == {"inserted": 6, "modified": 0, "unchanged": 0, "untouched": 0}
    water = [tuple(r) for r in lookup.water_after_level(loaded).collect()]
    assert water == [(79, "Lento", 37)]
    assert lookup.multi_type_count(loaded).first()[0] == 2


def test_backslash_escape_compat(spark):
    d = tempfile.mkdtemp(prefix="tessera-bs-")
    path = os.path.join(d, "x.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('a,b\n"x\\xa0y","q ""z"""\n')
    plain = csv_io.read_text_csv(spark, path, ["a", "b"]).first()
    compat = csv_io.read_text_csv(spark, path, ["a", "b"], backslash_escapes=True).first()
    assert (plain["a"], plain["b"]) == ("x\\xa0y", 'q "z"')
    assert (compat["a"], compat["b"]) == ("xxa0y", 'q "z"')


def test_numbers_too_large_are_counted(spark):
    rows = [("1", "5; 99999999999999999999", "7; 4294967296"), ("99999999999999999999", None, "None"), (None, "", "3")]
    df = spark.createDataFrame(rows, "numero string, numero_evol string, level_evol string")
    assert tuple(etl.overflow_counts(df).first()) == (1, 1, 1)
    assert tuple(etl.overflow_counts(df.select("numero")).first()) == (1, 0, 0)

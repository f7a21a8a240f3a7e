"""The four-stage command line, run as a separate process on fixture files."""

import csv
import os
import subprocess
import sys
import tempfile

from tessera.plans import etl

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_clean_load_query_cli():
    d = tempfile.mkdtemp(prefix="tessera-cli-")
    raw = os.path.join(d, "items.csv")
    with open(raw, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(etl.RAW_COLUMNS)          # no seq column: file order is the input order
        w.writerow(["#0079", "https://h/79", "Lento",
                    "[{'numero': '#0080', 'level': 'Level 37', 'item': None, 'nome': 'Lentor', 'url': 'u'}]",
                    "120 cm", "36 kg", "Water, Psychic", "{'Fire': '½'}", "[]"])
        w.writerow(["79", "https://h/dup", "Dup", "", "", "", "Fire", "", ""])
        w.writerow(["#0007", "https://h/7", "Aqualo",
                    "[{'numero': '#0008', 'level': 'Level 16', 'item': None, 'nome': 'Aqualor', 'url': 'u'}]",
                    "0.5 m", "9,0 kg", "Water", "", ""])
    run = lambda *a: subprocess.run([sys.executable, "-m", "tessera", *a], cwd=ROOT, capture_output=True,
                                    text=True, timeout=600)
    r = run("clean", raw, os.path.join(d, "clean"))
    assert r.returncode == 0, r.stderr[-2000:]
    r = run("load", os.path.join(d, "clean"), os.path.join(d, "coll"))
    assert r.returncode == 0, r.stderr[-2000:]
    assert "Upserts: 2 Modified: 0" in r.stdout
    r = run("query", os.path.join(d, "coll"))
    assert r.returncode == 0, r.stderr[-2000:]
    assert "multi-type documents: 1" in r.stdout
    assert "Lento" in r.stdout and "Dup" not in r.stdout and "total: 1" in r.stdout


def test_collect_cli_paginated(spark):
    from tessera.plans import catalogue
    d = tempfile.mkdtemp(prefix="tessera-cli-pages-")
    catalogue.derived_pages(spark, "/root/testdata/sf0.001").write.parquet(os.path.join(d, "pages"))
    r = subprocess.run([sys.executable, "-m", "tessera", "collect", os.path.join(d, "pages"),
                        catalogue.SITE + "/list/", os.path.join(d, "raw"), "--paginated"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    n = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .csv(os.path.join(d, "raw")).count()
    assert n == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def test_order_without_a_seq_column_is_file_then_line(spark, tmp_path):
    from tessera import __main__ as cli
    (tmp_path / "a.csv").write_text("k,v\n1,first\n2,x\n")
    (tmp_path / "b.csv").write_text("k,v\n1,later\n" + "".join(f"{i},pad\n" for i in range(10, 5000)))
    df = cli._read_rows(spark, str(tmp_path))
    rows = [r["v"] for r in df.where("k = '1'").orderBy("seq").collect()]
    assert rows == ["first", "later"] and df.count() == 4993 and df.select("seq").distinct().count() == 4993


def test_splittable_csv_keeps_cells_and_is_read_in_splits(spark, tmp_path):
    from tessera.sources import csv_io
    cells = ["a\nb", "\\n", "c\\", "\\\n\r\n", '"q", r', "", " x ", "\\\\n"]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "i string, s string")
    csv_io.write_csv(df.coalesce(1), str(tmp_path / "one"), splittable=True)
    back = csv_io.read_text_csv(spark, str(tmp_path / "one"), ["i", "s"], splittable=True)
    assert sorted(map(tuple, back.collect())) == sorted((str(i), c) for i, c in enumerate(cells))
    spark.range(200_000).selectExpr("cast(id as string) i", "repeat('x\\ny', 20) s").coalesce(1) \
        .transform(lambda d: csv_io.write_csv(d, str(tmp_path / "big"), splittable=True) or d)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        big = csv_io.read_text_csv(spark, str(tmp_path / "big"), ["i", "s"], splittable=True)
        assert big.rdd.getNumPartitions() > 4 and big.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

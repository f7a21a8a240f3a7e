"""Command line for the four stages (each a Spark job):

  python -m tessera collect PAGES LISTING_URL OUT      pages (Parquet: url, html) -> raw item CSV
                            [--paginated]             (LISTING_URL as a prefix of several listing pages)
  python -m tessera clean   RAW_CSV OUT                raw item CSV -> cleaned CSV
  python -m tessera load    CLEAN_CSV SNAPSHOT_ROOT    cleaned CSV -> new snapshot version (+ counters)
  python -m tessera query   SNAPSHOT_ROOT              the two lookups on the current snapshot

Runs with plain ``python`` (local master unless ``TESSERA_MASTER`` names
one) or inside an existing session. Keep-first dedup needs the input order:
a ``seq`` column is used when present; otherwise files count in the order of
their paths and lines in the order of the file (multi-line CSV files are read
whole, so a task sees a file's lines in order), pinned by writing the scan once
to the checkpoint folder.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _session():
    import os
    from pyspark.sql import SparkSession
    from .session import build_session
    active = SparkSession.getActiveSession()
    return active if active is not None else build_session(os.environ.get("TESSERA_MASTER", "local[*]"))


def _read_rows(spark, path, **options):
    """All-text rows of CSV files of any writer, read in splits, with ``seq``:
    their own, or file by path and then record."""
    from .sources import csv_io
    columns = _header(spark, path)
    if "seq" in columns:
        rows = csv_io.read_text_csv(spark, path, columns, parallel=True, **options)
        return rows.withColumn("seq", F.col("seq").try_cast("bigint"))
    return csv_io.read_text_csv(spark, path, columns, parallel=True, position="seq", **options)


def cmd_collect(a):
    from .plans import collect
    from .sources import csv_io
    spark = _session()
    pages = spark.read.parquet(a.pages)
    if a.paginated:
        # every page whose URL starts with LISTING_URL is a listing page,
        # ordered by the last number in its URL
        order = F.regexp_extract("url", r"([0-9]+)[^0-9]*$", 1).try_cast("bigint")
        items = collect.collect_items(pages, listing=F.col("url").startswith(a.listing_url),
                                      listing_order=F.coalesce(order, F.lit(0)))
    else:
        items = collect.collect_items(pages, a.listing_url)
    csv_io.write_csv(collect.items_as_raw_text(items), a.out)


def cmd_clean(a):
    from .plans import etl
    from .sources import csv_io
    spark = _session()
    raw = _read_rows(spark, a.raw, backslash_escapes=a.backslash_escapes)
    csv_io.write_csv(etl.clean_items(raw), a.out)


def cmd_load(a):
    from .operators import merge
    from .plans import etl
    from .sources import snapshot
    spark = _session()
    clean = _read_rows(spark, a.clean)
    over = etl.overflow_counts(clean).first()
    merged = etl.load_collection(etl.build_documents(clean))
    path = snapshot.write_snapshot(merged, a.root)
    c = merge.write_counters(spark.read.parquet(path).select(merge.OP)).first()
    print(f"Upserts: {c['inserted']} Modified: {c['modified']}")
    for field, n in over.asDict().items():
        if n:
            print(f"Left out, number too large: {field} {n}")


def cmd_query(a):
    from .operators import lookup
    from .sources import snapshot
    spark = _session()
    coll = snapshot.read_snapshot(spark, a.root)
    print("multi-type documents:", lookup.multi_type_count(coll).first()[0])
    res = lookup.water_after_level(coll, a.low, a.high)
    total = 0
    for total, row in enumerate(res.toLocalIterator(), 1):      # every row, a partition at a time
        print(*row, sep="\t")
    print("total:", total)


def _header(spark, path):
    """Column names from the CSV header line (one small read)."""
    first = spark.read.option("header", "false").csv(path).limit(1).collect()
    if not first:
        raise SystemExit(f"{path}: empty")
    return [c if c is not None else f"_c{i}" for i, c in enumerate(first[0])]


def main(argv=None):
    p = argparse.ArgumentParser(prog="python -m tessera")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("collect")
    c.add_argument("pages")
    c.add_argument("listing_url")
    c.add_argument("out")
    c.add_argument("--paginated", action="store_true",
                   help="LISTING_URL is a prefix: all pages under it are listing pages")
    c.set_defaults(fn=cmd_collect)
    c = sub.add_parser("clean")
    c.add_argument("raw")
    c.add_argument("out")
    c.add_argument("--backslash-escapes", action="store_true")
    c.set_defaults(fn=cmd_clean)
    c = sub.add_parser("load")
    c.add_argument("clean")
    c.add_argument("root")
    c.set_defaults(fn=cmd_load)
    c = sub.add_parser("query")
    c.add_argument("root")
    c.add_argument("--low", type=int, default=30)
    c.add_argument("--high", type=int, default=100)
    c.set_defaults(fn=cmd_query)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    sys.exit(main())

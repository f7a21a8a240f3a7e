import hashlib
from collections import Counter

from tessera.llm import line_dedup


def brute(docs, least):
    strip = " \t\n\x0b\f\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(d, (t or "").split("\n")) for d, t in docs]
    key = lambda x: x.strip(strip).translate(lower)
    n = Counter(k for _, ls in split for k in {key(x) for x in ls})
    out = []
    for d, ls in split:
        kept = [x for x in ls if not key(x) or n[key(x)] < least]
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, "\n".join([f"own {i}", " Shared LINE\t", "", "half" if i % 2 else "É half", f"own {i}"])) for i in range(12)]
    rows += [(100, None), (101, ""), (102, "shared line"), (None, "\n\nshared line\nx\u00a0"), (103, "a\n" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (2, 6, 13, 14, 15):
        got = sorted((tuple(r) for r in line_dedup.line_report(docs, least).collect()), key=str)
        assert got == brute(rows, least)


def test_repeated_rows_count_and_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "x\ny", "h1", 3)] * 3 + [(2, None, None, None)], "doc_id long, text string, dropped string, n_chars long")
    out = line_dedup.dedup_lines(docs, 3)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, "", "h1", 0)] * 3 + [(2, None, None, None)], key=str)
    assert line_dedup.dedup_lines(docs, 4).where("text = 'x\ny'").count() == 3


def test_odd_rows(odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.exceptAll(odd_docs).count() == 0 and out.count() == odd_docs.count()
    assert line_dedup.dedup_lines(no_docs).count() == 0

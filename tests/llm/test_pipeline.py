"""Every stage of the pipeline on its own input, against the brute-force
versions of the operators' tests."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import mixing, order_minhash as om, quality_rules
from test_mixing import targets
from test_order_minhash import brute as near_classes


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("sf"))
    r = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        words = [f"w{r.randrange(3000)}" for _ in range(r.randint(60, 160))]
        if i % 6 == 5:
            words = [w + "###" for w in words]
        if i % 10 == 3 and i > 10:
            words = rows[i - 3][1].split()[:-1] + ["edited"]
        text = " ".join(words) + ("\nshared line of the site" if i % 4 == 0 else "")
        rows.append((i, text, "en", ["hot", "hot", "a", "b", None][i % 5], len(text)))
        labels.append((i, int("###" not in text), 0))
    rows += [(1000, None, None, None, None), (1001, "short", "en", "a", 5), rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs, found = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        found.append((name, docs, spark.read.parquet(f"{sf}/{name}"), sf))
        docs = found[-1][2]
    return {name: (before, after, sf) for name, before, after, sf in found}


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_columns_stay(stages):
    for name, (before, after, _) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality(spark, stages):
    before, after, sf = stages["quality_rules"]
    kept = {r.doc_id for r in quality_rules.quality_report(before, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r.kept}
    assert texts(after) == [x for x in texts(before) if x[0] in kept]
    junk = {r.doc_id for r in before.collect() if "###" in (r.text or "")}
    assert {1000, 1001}.isdisjoint(kept) and len(junk) > 30 and len(kept & junk) <= 2 and len(kept) > 180


def test_lines(stages):
    before, after, _ = stages["line_dedup"]
    assert texts(after) == [(d, t.replace("\nshared line of the site", "")) for d, t in texts(before)]
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near(stages):
    before, after, _ = stages["near_dedup"]
    want = near_classes([(d, t) for d, t in texts(before)])
    assert [d for d, _ in texts(after)] == sorted(set(want.values()), key=str) and len(want) > after.count()


def test_mix(stages):
    before, after, _ = stages["source_mix"]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size, took = {}, {}
    for df, into in ((before, size), (after, took)):
        for r in df.collect():
            into[r.source] = into.get(r.source, 0) + count(r.text)
    want = targets(size)
    assert {s: int(want[s] + 1e-9) for s in want} == took
    assert mixing.WEIGHTS == (5, 2, 1)


def test_packing(stages):
    before, after, _ = stages["packing"]
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    want = []
    for d, text in texts(before):
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert len(ids) <= 2048
        want.append((d, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    rows = after.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)) == sorted(want)
    fill = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 2


def test_run_is_the_stages_in_a_row(spark, stages):
    sf = stages["packing"][2]
    key = lambda df: sorted((r.doc_id, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(stages["packing"][1])
    assert om.SIMILARITY == 0.8

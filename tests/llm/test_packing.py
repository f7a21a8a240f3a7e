import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=50, deadline=None)
def test_places_are_gapless_and_fit(sizes):
    bins, offsets = packing.sum_of_squares(sizes, 64)
    fill = {}
    for s, b, o in zip(sizes, bins, offsets):
        assert fill.get(b, 0) == o
        fill[b] = o + s
    assert all(v <= 64 for v in fill.values())
    assert len(fill) >= -(-sum(sizes) // 64)


def test_rule_against_a_plain_version():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 33, 300).tolist()
    gaps = []
    for s in sizes:
        def total(g):
            count = np.bincount([x for x in gaps if x], minlength=33).astype(int)
            if g is not None:
                count[g] -= 1
            if (g or 32) - s:
                count[(g or 32) - s] += 1
            return (count ** 2).sum()
        fits = sorted({g for g in gaps if g >= s})
        if fits:
            g = min(fits, key=lambda g: (total(g), g))
            gaps.remove(g)
        else:
            g = 32
        gaps.append(g - s)
    bins, _ = packing.sum_of_squares(sizes, 32)
    assert max(bins) + 1 == len(gaps)


@pytest.mark.parametrize("text", ["漢\u00a0b\n\n\nc\u00a0d", "漢\u2028a  b\u3000c\n\n\nd", "a\tb 漢\n\n\n\nc", "漢\x1c a\n\nb"])
def test_rare_blanks_do_not_hide_long_runs(text):
    encoder = packing.Encoder.of(PATH)
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == want


@given(st.lists(st.sampled_from(["漢", "b", "é", "\u00a0", "\u2028", "\u3000", "\t", "\x1c", "\x85", " ", "  ", "\n", "\n\n", "\n\n\n",
                                 "<|endoftext|>", "'s", "9", "."]), max_size=40).map("".join))
@settings(max_examples=3000, deadline=None)
def test_ids_with_rare_blanks_equal_the_library(text):
    encoder = packing.Encoder.of(PATH)
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == want


def test_full_pieces_are_numbered_by_content(spark):
    rows = [(i % 7, i % 3, 0, 8, i % 5) for i in range(600)] + [(None, 0, 0, 8, 1)] * 9000 + [(1, 0, 0, 3, 4)]
    t = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = [sorted(map(str, packing.pack(t.repartition(n), 8, 50).collect())) for n in (1, 7)]
    assert out[0] == out[1] and len(out[0]) == len(rows)
    ids = [r["sequence_id"] for r in packing.pack(t, 8, 50).collect()]
    assert len(set(ids)) == len(rows)


@given(st.lists(st.sampled_from([*"ab.,'s9!# \n\t\u00a0é\u0301漢\u2003", "<|endoftext|>", "'ll", "..."]), max_size=60).map("".join))
@settings(max_examples=500, deadline=None)
def test_parts_give_the_librarys_ids(text):
    e = packing.Encoder.of(PATH)
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(e.encode(text), "<u4").tolist() == want


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_documents_come_back_whole(spark, odd_docs, no_docs):
    got = packing.pack_documents(odd_docs, PATH, length=128, shard=50).collect()
    t = tokenizers.Tokenizer.from_file(PATH)
    want = []
    for r in odd_docs.collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(r.doc_id, i, s, n, zlib.crc32(ids[s:s + n].tobytes())) for i, (s, n) in enumerate(packing.cut(len(ids), 128))]
    key = str
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert by.get(r.sequence_id, 0) == r.offset
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 128
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_equal_rows_spread_over_shards(spark):
    cut = spark.range(3000).selectExpr("cast(null as long) doc_id", "0 piece", "0L start", "7L length", "5L ids_crc32")
    got = packing.pack(cut, length=64, shard=100).collect()
    per = np.bincount([r.sequence_id % 30 for r in got], minlength=30)
    assert len(got) == 3000 and per.max() < 200 and per.min() > 0


def test_few_sequences_beyond_the_bound(spark):
    sizes = np.clip(np.random.default_rng(4).lognormal(5.5, 1, 20_000), 1, 2047).astype(int).tolist()
    cut = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(sizes)], packing._PIECES)
    got = packing.pack(cut).select("sequence_id").distinct().count()
    assert got <= -(-sum(sizes) // 2048) * 1.0005 + 1

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import token_alignment as ta

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(text):
    """Groups and links by whole-text encoding and byte ranges."""
    t = ta.Tokenizers.of(A, B)
    if not text:
        return [], []
    ids = [t.a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)]
    said = [b"".join(table[i] for i in x) for table, x in zip((t.a_bytes, t.b_bytes), ids)]
    if any(s != (" " + text).encode() for s in said):
        return [], []
    spans = []
    for table, x in zip((t.a_bytes, t.b_bytes), ids):
        at, out = 0, []
        for i in x:
            out.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(out)
    cuts = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
    groups, links, left = [], [], [list(side) for side in spans]
    for side in left:
        side.reverse()
    while left[0]:
        group = [[], []]
        for side, found in zip(left, group):
            while True:
                found.append(side.pop())
                if found[-1][1] in cuts:
                    break
        groups.append("|".join(",".join(str(i) for _, _, i in found) for found in group))
        links += [(i, j) for x, y, i in group[0] for u, v, j in group[1] if x < v and u < y]
    return groups, links


def brute(texts):
    per = [plain(t) for t in texts]
    count = Counter(k for _, links in per for k in links)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    t = ta.Tokenizers.of(A, B)
    out = []
    for text, (groups, links) in zip(texts, per):
        n_a, n_b = (len(t.a.encode(" " + text, add_special_tokens=False).ids), len(t.b.encode(text))) if groups else (0, 0)
        out.append((n_a, n_b, len(groups), len(links), sum(count[k] == top[k[1]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out


odd = st.lists(st.sampled_from(list("aAb'st.9;)  \n\r\t\x1c\x85\u00a0\u2028é\u0301Σ漢🙂▁<\x00")
                               + ["<|endoftext|>", "<s>", "<0x41>", " the", "ing", "  ", ";\r\n"]), max_size=40).map("".join)


@given(st.lists(odd, max_size=4))
@settings(max_examples=400, deadline=None)
def test_segments_align_as_whole_texts(texts):
    table = ta.SegmentTable(ta.Tokenizers.of(A, B))
    assert table.t.cuts
    for text, got in zip(texts, ta.align_texts(texts, table, spelled=True), strict=True):
        groups, links = plain(text)
        assert got[5] == ";".join(groups)
        assert got[2] == len(groups) and got[3] == len(links)


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(ta, "SEGMENTS", 3)
    monkeypatch.setattr(ta, "SLICE", 5)
    texts = ["one two three", "", "four five", "one two three", "▁", "six seven eight nine"]
    table = ta.SegmentTable(ta.Tokenizers.of(A, B))
    assert [x[5] for x in ta.align_texts(texts, table, True)] == [";".join(plain(t)[0]) for t in texts]


@pytest.mark.parametrize("frequent", [0, 5, 1 << 17])
def test_report(spark, odd_docs, frequent):
    rows = odd_docs.collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, brute([r.text or "" for r in rows]))), key=str)
    got = [tuple(r) for r in ta.alignment_report(odd_docs, A, B, frequent).collect()]
    assert sorted(got, key=str) == want


def test_empty(spark, no_docs):
    assert ta.alignment_report(no_docs, A, B).collect() == []


def test_same_bytes_in_an_irregular_group(spark):
    """'aa' of one side half over 'aa' of the other adds to the pair's regular count."""
    texts = ["aaa aa aaaaa", "aaaaaaa aaaa", "baaa aa"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in ta.alignment_report(docs, A, B, 0).collect())
    assert got == [(i, *x) for i, x in enumerate(brute(texts))]

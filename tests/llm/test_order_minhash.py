import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import graph, order_minhash as om


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def seq(x):
    return np.array(x, dtype=np.uint64)


@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
@settings(max_examples=200, deadline=None)
def test_alignment_is_exact_without_a_band(a, b):
    assert om.banded_lcs(seq(a), seq(b), 100) == lcs(a, b)


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.data())
@settings(max_examples=200, deadline=None)
def test_near_is_exact_at_the_threshold(a, data):
    b = list(a)
    for _ in range(data.draw(st.integers(0, 6))):
        i = data.draw(st.integers(0, len(b)))
        b[i:i + data.draw(st.integers(0, 2))] = data.draw(st.lists(st.integers(0, 9), max_size=2))
    both = len(a) + len(b)
    common = lcs(a, b)
    assert om.near(seq(a), seq(b)) == (bool(b) and common / (both - common) >= 0.8 - 1e-12)


@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=40), st.integers(0, 12))
@settings(max_examples=200, deadline=None)
def test_the_band_bounds_the_matches(a, b, band):
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    row = [0] * (len(y) + 1)
    for i, u in enumerate(x):
        new = [0]
        for j, v in enumerate(y):
            new.append(row[j] + 1 if u == v and abs(i - j) <= band else max(row[j + 1], new[j]))
        row = new
    assert om.banded_lcs(seq(a), seq(b), band) == head + tail + row[-1]


def test_long_texts_are_aligned_in_a_window():
    a = np.random.default_rng(1).integers(0, 1 << 40, 60_000, dtype=np.uint64)
    b = np.delete(a, np.arange(50, 60_000, 100))
    b[::200] += np.uint64(1)
    assert om.near(a, b) and not om.near(a, b[::-1])


def text(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def edited(words, edits, seed):
    r = random.Random(seed)
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10 ** 6)}"
    return words


def brute(rows):
    sh = {d: om.shingles(om.word_hashes(t or "")) for d, t in rows}
    up = {d: d for d in sh}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sh)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (not len(sh[a]) and not len(sh[b])) or om.near(sh[a], sh[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: root(d) for d in ids}


def test_classes_against_all_pairs(spark):
    rows, base = [], text(300, 1)
    rows += [(i, " ".join(edited(base, i % 14, i))) for i in range(60)]             # chains around the threshold
    rows += [(100 + i, " ".join(text(120, 100 + i))) for i in range(40)]
    shared = text(60, 9)
    rows += [(200 + i, " ".join(text(100, 300 + i) + shared)) for i in range(40)]   # a common passage only
    rows += [(300, ""), (301, None), (302, "one two"), (303, " One\ttwo"), (304, " ".join(base[:299])), (305, " ".join(["be"] * 700)),
             (306, " ".join(["be"] * 800))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.kept) for r in om.near_report(docs).collect()}
    want = brute(rows)
    assert {d: c for d, (c, _) in got.items()} == want
    assert all(kept == (d == c) for d, (c, kept) in got.items())
    assert sorted(r.doc_id for r in om.drop_near(docs).collect()) == sorted(set(want.values()))


def test_odd_rows(odd_docs, no_docs):
    got = om.near_report(odd_docs).collect()
    assert len(got) == odd_docs.count()
    empty = {r.doc_id: r.class_id for r in got if r.doc_id in (2, 3, 6)}
    assert set(empty.values()) == {2}
    out = om.drop_near(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.where("doc_id = 5").count() == 1 and out.where("doc_id = 1").count() == 2 and out.where("doc_id is null").count() == 1
    assert om.near_report(no_docs).count() == 0 and om.drop_near(no_docs).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 50)] + [(100, 101), (103, 101), (7, 7), (101, 100)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 51)}, 100: 100, 101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0

import re
from collections import defaultdict

import pytest

from tessera.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **t}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 400)), ["hot", "b", "a", None, "\u00e9"][0 if i % 3 else i // 3 % 5]) for i in range(600)]
    return spark.createDataFrame(rows + [(900, None, "b"), (901, "", "only empty")], "doc_id long, text string, source string")


def test_targets_and_takes(corpus):
    got = mixing.mix_report(corpus, block=16).collect()
    sizes = defaultdict(int)
    for r in corpus.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = targets(sizes)
    by = {r.doc_id: r for r in got}
    taken = defaultdict(int)
    for r in corpus.collect():
        x = by[r.doc_id]
        assert x["source_size"] == sizes[r.source] and abs(x["target"] - want[r.source]) < 1e-6
        assert 0 <= x["taken"] <= 2 * x["size"]
        taken[r.source] += x["taken"]
    assert all(int(want[s] + 1e-9) == taken[s] for s in sizes)
    assert sorted(map(str, mixing.mix_report(corpus.repartition(7), block=16).collect())) == sorted(map(str, got))


def test_schedule_is_even(spark, corpus):
    _, slots = mixing.mix(corpus, block=4)
    rows = sorted((r.slot, r.sid) for r in slots.collect())
    n = len(rows)
    total = defaultdict(int)
    for _, s in rows:
        total[s] += 1
    seen = defaultdict(int)
    for i, (_, s) in enumerate(rows, 1):
        seen[s] += 1
        assert abs(seen[s] - total[s] * i / n) <= 12


def test_documents_of_the_mix(corpus):
    want = {r.doc_id: r.taken for r in mixing.mix_report(corpus).collect()}
    got = defaultdict(int)
    out = mixing.mix_documents(corpus)
    assert out.columns == corpus.columns
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
    assert {k: v for k, v in want.items() if v} == got


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix_report(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sum(r["taken"] for r in got if r["size"] == 0) == 0
    assert mixing.mix_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix_documents(odd_docs).where("text is null").count() == 0
    assert mixing.mix_report(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import features, labelled, quality_rules, ranking


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i:i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@given(st.text(alphabet=st.sampled_from(list("ab é#| \n\t ")), max_size=80))
@settings(max_examples=300, deadline=None)
def test_basics_against_a_plain_version(text):
    raw = text.encode()
    words = raw.split()
    assert tuple(features.basics(raw, words, features.word_ids(words))) == plain(text)


@pytest.fixture(scope="module")
def corpus(spark):
    r = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        words = [("".join(r.choice(list("abcdefgh"), 5)) + ("" if good else r.choice(["###", "$$$", "!!"]))) for _ in range(int(r.integers(60, 200)))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    rows.append((1000, "too short"))
    rows.append((1001, "again and " * 100))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_keep_good_and_reject_bad(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in quality_rules.quality_report(docs, labels).collect()}
    assert got[1000].base_failed and got[1001].base_failed and not got[1001].kept
    known = [(got[r.doc_id], r.quality) for r in labels.collect()]
    assert np.mean([g.kept == bool(q) for g, q in known]) > 0.98
    assert abs(np.mean([g.probability - q for g, q in known])) < 0.05                 # calibrated
    assert {r.doc_id for r in quality_rules.keep_quality(docs, labels).collect()} == {d for d, g in got.items() if g.kept}


def test_ranking_on_held_out_rows(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in ranking.rank_documents(docs, labels).collect()}
    assert all(g.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, g in got.items())
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([g.predicted == q for g, q in held]) > 0.97
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for g in got.values())


def test_held_out_labels_change_nothing(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", __import__("pyspark.sql.functions", fromlist=["when"]).when(
        ranking.held_out(), 1 - labels.quality).otherwise(labels.quality).cast("int"))
    a, b = (sorted(map(tuple, ranking.rank_documents(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_pairs_put_label_one_first():
    y = np.array([1, 0, 1, 1, 0])
    better, worse = ranking.preference_pairs(y, 50)
    assert (y[better] == 1).all() and (y[worse] == 0).all()


def test_sample_is_bounded(corpus):
    x, y = labelled.sample(*corpus, rows=50)
    assert x.shape[0] == len(y) == 50


def test_every_labelled_row_is_learned_from(corpus):
    docs, labels = corpus
    seen = lambda x, y: np.append(x.astype(np.float64).mean(axis=0), [len(y)])
    whole, n, ones = labelled.fit_in_chunks(docs, labels, seen)
    parts, m, _ = labelled.fit_in_chunks(docs, labels, seen, chunk_rows=40)
    assert n == m == labels.count() and ones == labels.where("quality = 1").count()
    assert whole[-1] == n and parts[-1] < 100 and np.allclose(whole[:-1], parts[:-1])
    assert labelled.fit_in_chunks(docs, labels, lambda x, y: None) == (None, n, ones)


def test_chunks_are_averaged_into_a_model(corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(labelled.fit_in_chunks, "__defaults__", (None, 100))
    ranked = {r.doc_id: r.predicted for r in ranking.rank_documents(docs, labels).collect()}
    judged = {r.doc_id: r.kept for r in quality_rules.quality_report(docs, labels).collect()}
    known = labels.collect()
    assert np.mean([ranked[r.doc_id] == r.quality for r in known]) > 0.97
    assert np.mean([judged[r.doc_id] == bool(r.quality) for r in known]) > 0.97


def test_odd_rows(odd_docs, no_docs, odd_labels):
    none = odd_labels.where("false")
    for labels in (odd_labels, none):
        assert quality_rules.quality_report(odd_docs, labels).count() == odd_docs.count()
        assert ranking.rank_documents(odd_docs, labels).count() == odd_docs.count()
        kept = quality_rules.keep_quality(odd_docs, labels)
        assert kept.columns == odd_docs.columns and kept.exceptAll(odd_docs).count() == 0
        assert quality_rules.keep_quality(no_docs, labels).count() == 0 and ranking.rank_documents(no_docs, labels).count() == 0

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm_scoring as lm


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), lm.END]


@pytest.fixture(scope="module")
def corpus(spark):
    r = np.random.default_rng(3)
    langs = [["".join(r.choice(list(a), 4)) for _ in range(60)] for a in ("abcde", "fghij", "klmno")]
    rows = [(i, " ".join(r.choice(langs[i % 3], int(r.integers(20, 80)))) + ("\n" if i % 2 else " New%d" % i)) for i in range(300)]
    return spark.createDataFrame(rows + [(1000, None), (1001, "")], "doc_id long, text string")


def test_base_against_brute_force_and_model_beats_it_held_out(corpus):
    rows = corpus.collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = Counter(w for r in train for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in lm.score_documents(corpus).collect()}
    for r in rows:
        g, w = got[r.doc_id], tokens(r.text)
        assert g.held_out == (r not in train) and g.n_tokens == len(w) and g.train_tokens == n
        assert g.n_known == sum(counts[x] > 0 for x in w)
        assert abs(g.base_score - sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) < 1e-6
    held = [got[r.doc_id] for r in rows if got[r.doc_id].held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_rare_words_are_joined(corpus, monkeypatch):
    want = sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm.score_documents(corpus).collect())
    monkeypatch.setattr(lm, "top_words", lambda v: {})
    assert sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm.score_documents(corpus).collect()) == want


def test_context_counts_over_many_tasks(spark, monkeypatch):
    words = [(i % 6, f"w{i % 90}".encode(), 1 + i % 5) for i in range(300)]
    df = spark.createDataFrame(words, "class int, word binary, n long")
    want = lm.empty_tables()
    lm.add_words(want, [w for _, w, _ in words], np.array([c for c, _, _ in words]), np.array([n for _, _, n in words]))
    monkeypatch.setattr(lm, "WORDS_PER_TABLE", 30)
    monkeypatch.setattr(lm, "_PARTS", 3)
    assert all((a == b).all() for a, b in zip(lm.count_contexts(df, 300), want))


def test_bits_are_a_distribution():
    words, classes = [b"ab", b"abc", b"b"], np.zeros(3, dtype=np.int64)
    tables = lm.empty_tables()
    lm.add_words(tables, words, classes, np.array([5, 2, 9]))
    mixer = lm.train_mixer(tables, words, classes)
    every = [bytes([i]) for i in range(256) if i != 0x20]
    one = sum(10 ** lm.word_scores(lm.planes(tables), mixer, [w], np.zeros(1, dtype=np.int64))[0] for w in every)
    assert 0 < one < 1                                       # one-byte words and what is left for the others


def test_planes_say_what_inputs_say():
    rng = np.random.default_rng(0)
    tables = [rng.integers(0, 300, (1000, 2)).astype(np.float32) * rng.integers(0, 2, (1000, 1)) for _ in lm.TABLE_BITS]
    x, gate = lm.inputs(tables)
    at = np.arange(1000)
    two, three, five, word = (lm._fetch(p, at) for p in lm.planes(tables))
    assert np.allclose(x[:, :5], np.column_stack([two[:, 0], three[:, 0], five[:, 0], word[:, :2]]), atol=0.01)
    assert (gate == (word[:, 2] + five[:, 1])).all()


def test_context_counts_follow_the_words():
    tables = lm.empty_tables()
    lm.add_words(tables, [b"ab", b"a"], np.zeros(2, dtype=np.int64), np.array([3, 4]))
    assert [int(t.sum()) for t in tables] == [8 * (3 * 3 + 2 * 4)] * len(tables)


def test_classes_are_the_means_of_all_training_rows(corpus):
    rows = lm._texts(corpus)
    start = np.random.default_rng(1).random((lm.CLASSES, 1024)).astype(np.float32)
    start /= np.linalg.norm(start, axis=1, keepdims=True)
    x = np.array([lm.profile(r.text.encode().lower()) for r in rows.where("not held_out").collect()])
    own = (x @ start.T).argmax(axis=1)
    for i, c in enumerate(lm.refine_classes(rows, start)):
        mean = x[own == i].sum(axis=0) if x[own == i].any() else start[i]
        assert np.allclose(c, mean / np.linalg.norm(mean), atol=1e-5)


def test_mixer_is_fitted_on_every_token(spark):
    words, classes, n = [b"ab", b"abc", b"b", b"zz"], np.array([0, 1, 0, 5]), np.array([500, 20, 900, 1])
    tables = lm.empty_tables()
    lm.add_words(tables, words, classes, n)
    start = lm.train_mixer(tables, [], np.zeros(0, dtype=np.int64))
    counts = spark.createDataFrame(list(zip(classes.tolist(), words, n.tolist())), "class int, word binary, n long")
    many = lm.mixer_stats(tables, start.weights, [w for w, k in zip(words, n) for _ in range(k)], np.repeat(classes, n),
                          np.ones(n.sum(), dtype=np.int64))
    want, got = lm.newton(start.weights, many), lm.fit_mixer(counts, 4, tables, start)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(want, got))
    scores = [float(lm.word_scores(lm.planes(tables), m, words, classes) @ n) for m in (start, got)]
    assert scores[1] > scores[0]


def test_words_that_begin_alike_share_their_bytes():
    words = sorted(b"%s%d" % (w, i) for w in (b"a", b"ab", b"banana", b"x" * 300) for i in (1, 11, 12, 2)) * 2
    classes, n = np.repeat([0, 3], len(words) // 2), np.arange(1, len(words) + 1)
    found = lm.edges(words, classes)
    begun = {}
    for w, c, k in zip(words, classes.tolist(), n.tolist()):
        for i in range(len(w) + 1):
            at = c, (w + b" ")[:i + 1]
            begun[at] = begun.get(at, 0) + k
    assert len(found.byte) == len(begun) and sorted(found.sums(n)) == sorted(begun.values())

    alone, tables = lm.empty_tables(), lm.empty_tables()
    lm.add_words(tables, words, classes, n)
    for i in range(len(words)):
        lm.add_words(alone, words[i:i + 1], classes[i:i + 1], n[i:i + 1])
    assert all((a == b).all() for a, b in zip(alone, tables))
    mixer = lm.train_mixer(tables, words, classes)
    parts = [(words[i:i + 1], classes[i:i + 1], n[i:i + 1]) for i in range(len(words))]
    assert np.allclose(lm.mixer_stats(tables, mixer.weights, words, classes, n),
                       sum(lm.mixer_stats(tables, mixer.weights, *p) for p in parts))
    made = lm.planes(tables)
    order = np.random.default_rng(0).permutation(len(words))
    got = lm.word_scores(made, mixer, [words[i] for i in order], classes[order])
    assert np.allclose(got, [lm.word_scores(made, mixer, *parts[i][:2])[0] for i in order])


def test_sums_of_tasks_are_added_by_block(spark):
    sums = [np.arange(lm._SUMS * 2 + 3) * float(i) for i in range(1, 6)]
    parts = spark.createDataFrame([(int(r["at"]), r["block"]) for s in sums for r in lm._laid(s).to_dict("records")],
                                  lm._SUMS_SCHEMA).repartition(5)
    assert parts.count() == 3 * len(sums) and (lm._summed(parts, len(sums[0])) == sum(sums)).all()


def test_a_row_of_counts_for_every_word_of_a_class(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = [(i, "Both both " + ("mine" if i in held else "theirs")) for i in range(60)]
    rows = lm._texts(spark.createDataFrame(texts, "doc_id long, text string")).selectExpr("*", "cast(doc_id % 2 as int) class")
    got = {(r["class"], bytes(r.word)): r for r in lm.count_words(rows).collect()}
    for c in (0, 1):
        train = sum(i % 2 == c and i not in held for i in range(60))
        want = {b"both": 2 * train, b"theirs": train, lm.END: train} | ({b"mine": 0} if any(i % 2 == c for i in held) else {})
        assert {w: r.n for (z, w), r in got.items() if z == c} == want
    assert all(r.total == sum(s.n for (_, v), s in got.items() if v == w) for (_, w), r in got.items())
    assert sorted(w for (_, w), r in got.items() if r.first) == sorted({w for _, w in got})


def test_scores_are_the_same_broadcast_or_joined(corpus, monkeypatch):
    want = {r.doc_id: (r.score, r.bits_per_byte) for r in lm.score_documents(corpus).collect()}
    monkeypatch.setattr(lm, "top_words", lambda v: {})
    got = {r.doc_id: (r.score, r.bits_per_byte) for r in lm.score_documents(corpus).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[d], want[d], rtol=1e-9) for d in want)


def test_long_ids_stay_beside_a_null_id(spark):
    ids = [None, (1 << 60) + 1, -(1 << 62) - 3]
    docs = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in lm.score_documents(docs).collect()} == set(ids)


def test_odd_rows(odd_docs, no_docs):
    got = lm.score_documents(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.score_documents(no_docs).count() == 0


def test_mixer_is_settled_over_all_training_words(corpus, monkeypatch):
    used, planes, score_words = {}, lm.planes, lm.score_words
    monkeypatch.setattr(lm, "planes", lambda tables: used.update(tables=[t.copy() for t in tables]) or planes(tables))
    monkeypatch.setattr(lm, "score_words", lambda counts, n, made, mixer: used.update(counts=counts, mixer=mixer) or
                        score_words(counts, n, made, mixer))
    lm.score_documents(corpus)
    rows = used["counts"].where("n > 0").collect()
    args = [bytes(r.word) for r in rows], np.array([r["class"] for r in rows]), np.array([r.n for r in rows])
    weights = used["mixer"].weights
    further = lm.newton(weights, lm.mixer_stats(used["tables"], weights, *args)).weights
    assert np.abs(further - weights).max() < 0.01


def test_where_the_mixer_begins_does_not_matter(spark):
    r = np.random.default_rng(5)
    words = sorted({bytes(r.integers(97, 102, int(k)).astype(np.uint8)) for k in r.integers(1, 6, 400)})
    classes, n = np.zeros(len(words), dtype=np.int64), r.integers(1, 200, len(words))
    tables = lm.empty_tables()
    lm.add_words(tables, words, classes, n)
    counts = spark.createDataFrame([(0, w, int(k)) for w, k in zip(words, n)], "class int, word binary, n long")
    begun = lm.train_mixer(tables, [], classes[:0])
    far = begun._replace(weights=begun.weights[:, ::-1] + 1)
    online, first, other = (lm.fit_mixer(counts, len(words), tables, s, least=1e-8) for s in (None, begun, far))
    assert np.allclose(online.weights, first.weights, atol=1e-2) and np.allclose(other.weights, first.weights, atol=1e-2)
    assert np.abs(first.weights - begun.weights).max() > 0.05

    twice = [w for w, k in zip(words[:50], n) for _ in range(k)]
    want = lm.train_mixer(tables, twice, np.zeros(len(twice), dtype=np.int64))
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(want, lm.train_mixer(tables, words[:50], classes[:50], n[:50])))


def test_bits_of_a_long_word_come_in_pieces():
    rng = np.random.default_rng(6)
    words = [bytes(rng.integers(97, 100, k).astype(np.uint8)) for k in (3, 5000, 9)]
    classes, n = np.zeros(3, dtype=np.int64), np.array([4, 2, 7])
    tables = lm.empty_tables()
    lm.add_words(tables, words, classes, n)
    parts = list(lm.bits(tables, words, classes, n, 700))
    assert max(len(p.n) for p in parts) <= 8 * 700
    whole, = lm.bits(tables, words, classes, n, 100_000)
    assert sum(p.n.sum() for p in parts) == whole.n.sum() and all((np.diff(p.gate.astype(int)) >= 0).all() for p in parts)
    assert np.allclose(sum(p.x.astype(float) @ (p.n * p.one) for p in parts), whole.x.astype(float) @ (whole.n * whole.one))

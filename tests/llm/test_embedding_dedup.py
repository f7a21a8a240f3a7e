import numpy as np
import pytest

from tessera.llm import embedding_dedup as ed


def brute(rows, t=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, up = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, v) in enumerate(ok):
        for j, w in ok[:k]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= t:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted((i, links[i], root(i), i == root(i)) for i, _ in rows)


@pytest.mark.parametrize("per_cell,block", [(200, 1024), (20, 8)])
def test_against_brute_force(spark, monkeypatch, per_cell, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 24))
    x = np.concatenate([x, x[:60] + 0.05 * r.normal(size=(60, 24)), np.repeat(x[:1], 25, 0) + 0.08 * r.normal(size=(25, 24)), np.repeat(x[5:6], 20, 0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [None] * 24), (904, [float("nan")] * 24), (905, [float("inf")] * 24),
             (906, [1.0, 0.0]), (907, [2.0, 0.0])]
    got = ed.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), per_cell=per_cell).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_rows_that_repeat_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.01], None), (None, [1.0, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    got = sorted(map(tuple, ed.link_vectors(df).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=str)
    assert ed.link_vectors(df.where("false")).count() == 0


def test_links_across_borders_of_low_rank_vectors(spark):
    r = np.random.default_rng(3)
    x = (r.normal(size=(700, 6)) @ r.normal(size=(6, 64))).astype("float32")
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = ed.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), per_cell=20).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_rows_that_share_an_id_but_not_a_vector(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (3, None), (4, [-1.0, 0.0])]
    got = sorted(map(tuple, ed.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)])


def test_memory_with_many_cells():
    import tracemalloc
    r = np.random.default_rng(1)
    x, centres = ed.unit(r.normal(size=(10_000, 64))), ed.unit(r.normal(size=(4096, 64)))
    tracemalloc.start()
    home, cells = ed.near_cells(x, centres, 0.99)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    dots = x[:50] @ centres.T
    assert (home[:50] == dots.argmax(axis=1)).all() and all(h in c for h, c in zip(home.tolist(), cells))

"""Keyed operators, chain walks, fan-out/fan-in and the patch-upsert."""

from pyspark.sql import functions as F

from tessera.operators import chain, dedup, enrich, merge


def test_keep_first_null_key_and_partitions(spark):
    data = [(None, "a", 0), (None, "b", 1), (1, "c", 2), (1, "d", 3), (2, "e", 5), (2, "f", 4)]
    df = spark.createDataFrame(data, "k long, v string, seq long")
    want = {(None, "a", 0), (1, "c", 2), (2, "f", 4)}
    for n in (1, 3, 7):
        got = {tuple(r) for r in dedup.keep_first(df.repartition(n), "k", "seq").collect()}
        assert got == want
    once = dedup.keep_first(df, "k", "seq")
    assert {tuple(r) for r in dedup.keep_first(once, "k", "seq").collect()} == want  # idempotent


def test_first_match_else_first(spark):
    df = spark.createDataFrame([(1, 0, "view"), (1, 1, "buy"), (1, 2, "buy"), (2, 0, "view"), (2, 1, "view")],
                               "g int, t int, kind string")
    got = {tuple(r) for r in dedup.first_match_else_first(df, "g", F.col("kind") == "buy", "t", ["t"]).collect()}
    assert got == {(1, 1, True), (2, 0, False)}


def test_pair_with_next(spark):
    df = spark.createDataFrame([(1, i, f"x{i}") for i in range(5)] + [(2, 0, "y0")], "c int, p int, v string")
    got = sorted(tuple(r) for r in chain.pair_with_next(df, "c", "p", ["v"]).collect())
    assert got == [(1, 0, "x0", "x1"), (1, 2, "x2", "x3"), (1, 4, "x4", None), (2, 0, "y0", None)]


def test_successors_after_first_match(spark):
    df = spark.createDataFrame([(1, 0, "Alpha"), (1, 1, " beta "), (1, 2, "Gamma"), (1, 3, "Beta"),
                                (2, 0, "Delta")], "c int, p int, n string")
    got = sorted(tuple(r) for r in chain.successors_after_first_match(
        df, "c", "p", chain.name_equals(F.col("n"), "BETA")).collect())
    assert got == [(1, 2, "Gamma"), (1, 3, "Beta")]


def test_fan_out_fan_in_with_fallback(spark):
    items = spark.createDataFrame([("i1", ["u1", "u2"]), ("i2", []), ("i3", ["u9"])], "item string, urls array<string>")
    pages = spark.createDataFrame([("u1", "d1"), ("u2", "d2")], "url string, descricao string")
    ex = enrich.explode_list(items, "urls", "pos", "url")
    looked = enrich.lookup_with_fallback(ex, pages, "url", "url", "descricao", "desc")
    back = enrich.fan_in(looked, ["item"], "pos", ["url", "desc"], "habilidades")
    got = {r["item"]: [tuple(x) for x in r["habilidades"]] for r in back.collect()}
    assert got == {"i1": [("u1", "d1"), ("u2", "d2")], "i2": [],
                   "i3": [("u9", enrich.MISSING_PAGE_TEXT)]}


SCHEMA = "numero long, nome string, peso double, tipos array<string>"


def _base(spark):
    return spark.createDataFrame([(1, "A", 1.0, ["Water"]), (2, "B", 2.0, ["Fire", "Ice"]),
                                  (3, "C", 3.0, ["Rock"]), (4, "D", 4.0, None)], SCHEMA)


def _batch(spark):
    return spark.createDataFrame([
        (1, "A", None, ["Water", "Ice"], 1),   # null field does not overwrite; list replaces
        (1, "A2", 7.0, None, 2),               # same key twice: folded, latest non-null wins
        (2, None, None, [], 3),                # empty list over a set list replaces
        (None, "C", 9.0, None, 4),             # key-less, matched by name
        (None, None, 1.5, ["X"], 5),           # key-less without name: no target -> insert
        (10, "N", 2.0, ["Y"], 6),              # new key
        (None, "Z", 0.5, None, 7),             # key-less, unknown name -> insert
    ], SCHEMA + ", seq long")


def test_upsert_semantics_and_counters(spark):
    merged = merge.upsert(_base(spark), _batch(spark), "numero", "nome", "seq")
    got = {(r["numero"], r["nome"]): (r["peso"], r["tipos"], r["op"]) for r in merged.collect()}
    assert got == {
        (1, "A2"): (7.0, ["Water", "Ice"], "modify"),
        (2, "B"): (2.0, [], "modify"),
        (3, "C"): (9.0, ["Rock"], "modify"),
        (4, "D"): (4.0, None, "keep"),
        (None, None): (1.5, ["X"], "insert"),
        (10, "N"): (2.0, ["Y"], "insert"),
        (None, "Z"): (0.5, None, "insert"),
    }
    c = merge.write_counters(merged).first().asDict()
    assert c == {"inserted": 3, "modified": 3, "unchanged": 0, "untouched": 1}


def test_upsert_is_idempotent(spark):
    once = merge.upsert(_base(spark), _batch(spark), "numero", "nome", "seq").drop("op")
    twice = merge.upsert(once, _batch(spark), "numero", "nome", "seq")
    c = merge.write_counters(twice).first().asDict()
    assert c["inserted"] == 0 and c["modified"] == 0
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.drop("op").collect()))


def test_secondary_key_targets_least_primary_key(spark):
    base = spark.createDataFrame([(5, "Same", 1.0, None), (3, "Same", 1.0, None)], SCHEMA)
    upd = spark.createDataFrame([(None, "Same", 8.0, None, 1)], SCHEMA + ", seq long")
    got = {r["numero"]: (r["peso"], r["op"]) for r in merge.upsert(base, upd, "numero", "nome", "seq").collect()}
    assert got == {3: (8.0, "modify"), 5: (1.0, "keep")}


def test_fan_in_chunked_is_whole_and_bounded(spark):
    rows = [("hot", i, f"v{i}") for i in range(10)] + [("cold", 0, "c0"), ("none", None, None)]
    df = spark.createDataFrame(rows, "item string, pos int, v string")
    out = enrich.fan_in(df, ["item"], "pos", ["v"], "vals", chunk_size=4).collect()
    by_item = {}
    for r in sorted(out, key=lambda r: (r["item"], r["chunk"])):
        assert len(r["vals"]) <= 4
        by_item.setdefault(r["item"], []).extend(x["v"] for x in r["vals"])
    assert by_item == {"hot": [f"v{i}" for i in range(10)], "cold": ["c0"], "none": []}


def test_keep_first_digest_equals_exact(spark):
    rows = [(None, 0, "a"), ("x" * 5000, 1, "b"), ("x" * 5000, 2, "c"), ("", 3, "d"), (None, 4, "e"), ("", 5, "f")]
    df = spark.createDataFrame(rows, "t string, seq long, v string")
    exact = sorted((tuple(r) for r in dedup.keep_first(df, "t", "seq").collect()), key=lambda r: r[1])
    hashed = sorted((tuple(r) for r in dedup.keep_first(df, "t", "seq", digest=True).collect()),
                    key=lambda r: r[1])
    assert exact == hashed and len(exact) == 3


def test_keep_first_wide_equals_default(spark):
    data = [(None, "a", 0), (None, "b", 1), (1, "c", 2), (1, "d", 3), (2, "e", 5), (2, "f", 4)]
    df = spark.createDataFrame(data, "k long, v string, seq long")
    want = {(None, "a", 0), (1, "c", 2), (2, "f", 4)}
    assert {tuple(r) for r in dedup.keep_first(df, "k", "seq", wide=True).collect()} == want
    plan = dedup.keep_first(df, "k", "seq", wide=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "min_by" not in plan


def test_drop_all_null_strict(spark):
    from tessera.operators import conform
    df = spark.createDataFrame([(1, "a", None), (2, " None ", ""), (3, None, None), (4, "", "x")], "id int, s string, t string")
    assert [r.id for r in conform.drop_all_null(df, exclude=("id",)).orderBy("id").collect()] == [1, 2, 4]
    assert [r.id for r in conform.drop_all_null(df, exclude=("id",), strict=True).orderBy("id").collect()] == [1, 4]


def test_sparse_json_leaves_out_top_level_nulls_only(spark):
    from tessera.operators import conform
    df = spark.createDataFrame([(1, None, [("a", None)], {"k": None}, [])],
                               "id int, s string, l array<struct<n:string,u:string>>, m map<string,string>, e array<string>")
    got = conform.sparse_json(df, df.columns).first()["json"]
    assert got == '{"id":1,"l":[{"n":"a","u":null}],"m":{"k":null},"e":[]}'

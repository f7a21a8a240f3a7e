"""SQL functions give what the Column functions give, in native plans."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import sql_functions

TEXTS = [None, "", " none ", "NaN", " #25 it's “x”", "Level 36", "at level 7", "#0", "#2001", "no. 151", "7", "100", "101",
         "http://x/5", "1.234,5 kg", "12,5", "99999999999999999999", "a| b ||c", "a; ;b ", "　x ", "\\|;", "x\x1cy", "'; --"]


@pytest.fixture(scope="module")
def texts(spark):
    sql_functions.register(spark)
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, x string")


def test_scalar_functions(spark, texts):
    pairs = {"strip_text": S.ustrip("x"), "t1a_value": S.null_tokens("x"), "t1b_value": S.null_tokens("x", False),
             "t3_int": S.to_int("x"), "t4_decimal": S.parse_decimal("x"), "t10_parts": S.split_multi("x"),
             "t12_id": S.dex_id("x"), "t13_level": S.level("x")}
    assert set(pairs) == set(sql_functions.FUNCTIONS)
    want = texts.orderBy("i").select(*[c.alias(n) for n, c in pairs.items()])
    got = spark.sql(f"SELECT {', '.join(f'{n}(x) AS {n}' for n in pairs)} FROM {{t}} ORDER BY i", t=texts)
    assert got.dtypes == want.dtypes
    assert got.collect() == want.collect()


def test_table_function_and_plan(spark, texts):
    got = spark.sql("SELECT i, e.pos, e.elem FROM (SELECT i, t10_parts(x) AS l FROM {t} WHERE t12_id(x) IS NULL) s, "
                    "LATERAL u4_elements(s.l) e", t=texts)
    want = texts.where(S.dex_id("x").isNull()).select("i", F.posexplode(S.split_multi("x")).alias("pos", "elem"))
    assert sorted(got.collect()) == sorted(want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_registering_again_replaces(spark):
    assert sql_functions.register(spark) == sql_functions.register(spark)

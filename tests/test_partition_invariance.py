"""Results do not depend on the number of shuffle partitions."""

import pytest

from oracle_compare import rows_of

SF = "/root/testdata/sf0.001"
def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_same_result_for_1_and_13_shuffle_partitions(spark, name):
    from __spark_entry__ import queries
    fn = queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(rows_of(fn(spark, SF).toPandas()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]

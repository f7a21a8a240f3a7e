"""Versioned snapshots: only committed versions are visible."""

import tempfile

import pytest

from tessera.sources import snapshot


def test_uncommitted_version_is_invisible_and_replaced(spark):
    root = tempfile.mkdtemp(prefix="tessera-snap-")
    assert snapshot.current_version(spark, root) is None
    snapshot.write_snapshot(spark.range(3).toDF("x"), root)
    # a load that died after writing its data but before committing
    spark.range(100).toDF("x").write.parquet(snapshot.version_path(root, 2))
    assert snapshot.current_version(spark, root) == 1
    assert snapshot.read_snapshot(spark, root).count() == 3
    path = snapshot.write_snapshot(spark.range(5).toDF("x"), root, "s", 7)
    assert path == snapshot.version_path(root, 2)
    assert snapshot.read_snapshot(spark, root).count() == 5
    assert snapshot.committed_versions(spark, root) == [1, 2] and snapshot.last_epoch(spark, root, "s") == 7


def test_unreadable_markers_raise_and_keep_versions(spark):
    import os
    root = tempfile.mkdtemp(prefix="tessera-snap-")
    for n in (3, 4):
        snapshot.write_snapshot(spark.range(n).toDF("x"), root)
    stray = os.path.join(root, snapshot.COMMITS, "stray")
    os.mkdir(stray)
    with open(os.path.join(stray, "x.txt"), "w") as f:
        f.write("?")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error for a folder that isn't laid out by version
        snapshot.write_snapshot(spark.range(9).toDF("x"), root)
    assert spark.read.parquet(snapshot.version_path(root, 1)).count() == 3
    assert spark.read.parquet(snapshot.version_path(root, 2)).count() == 4

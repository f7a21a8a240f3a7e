"""Versioned Parquet snapshots of a document collection.

A collection is a folder holding one sub-folder per version
(``version=000001``, ...) and one commit marker per committed version
(``commits/version=000001``, a one-line text dataset holding, as JSON, the last
batch id applied of every stream that wrote into the collection). The data of a version is written completely first
(Spark's commit protocol makes task retries and lost executors safe), its
marker second; the current version is the highest one with a marker. So a
write never touches the version being read, a reader never sees a partial
load, and a crash between the two steps leaves an invisible version that the
next write replaces.

One writer per collection at a time (as in the source, which loads from one
process). The folder must be on shared storage; callers get it from
``tessera.session.scratch_path`` (under ``spark.checkpoint.dir``) or pass
their own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

COMMITS = "commits"


_MARKER_RE = re.compile(r"/version=(\d+)/[^/]+$")


def _marker_files(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed version -> its marker file (a file listing, no job). Only a
    missing folder means that nothing is committed; any other failure is
    raised, since a version must never be taken for free because its marker
    could not be read."""
    try:
        files = spark.read.text(f"{root}/{COMMITS}").inputFiles()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {int(m.group(1)): f for f in files if (m := _MARKER_RE.search(f))}


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, oldest first (for retention jobs)."""
    return sorted(_marker_files(spark, root))


def current_version(spark: SparkSession, root: str) -> int | None:
    found = committed_versions(spark, root)
    return found[-1] if found else None


def stream_epochs(spark: SparkSession, root: str) -> dict[str, int]:
    """Stream id -> last batch id that the current version holds."""
    markers = _marker_files(spark, root)
    if not markers:
        return {}
    row = spark.read.text(markers[max(markers)]).first()     # one tiny file
    return json.loads(row[0]) if row is not None and row[0] else {}


def last_epoch(spark: SparkSession, root: str, stream: str) -> int | None:
    """Last batch id of ``stream`` that the current version holds, if any."""
    return stream_epochs(spark, root).get(stream)


def version_path(root: str, version: int) -> str:
    return f"{root}/version={version:06d}"


def write_snapshot(df: DataFrame, root: str, stream: str | None = None, epoch: int | None = None,
                   before_commit: Callable[[str, int], None] | None = None,
                   write: Callable[[DataFrame, str], None] | None = None) -> str:
    """K2/K3: write ``df`` as the next version and commit it. Every write is a
    full refresh of the collection (the source drops the collection before
    loading); older versions stay readable until removed.

    ``stream`` and ``epoch`` record a streaming batch; a write without them
    carries on what is recorded of the streams. ``before_commit(path, version)``
    writes what belongs to the version (its counters): it becomes valid with
    the marker, or not at all. A committed version is never written again.
    ``write(df, path)`` lays the version's files out (bucketed, clustered)
    where plain Parquet is not wanted."""
    spark = df.sparkSession
    nxt = (current_version(spark, root) or 0) + 1
    epochs = stream_epochs(spark, root)
    if stream is not None:
        epochs[stream] = epoch
    path = version_path(root, nxt)
    if write is None:
        df.write.mode("overwrite").parquet(path)
    else:
        write(df, path)
    if before_commit is not None:
        before_commit(path, nxt)
    spark.createDataFrame([(json.dumps(epochs),)], "value string").coalesce(1) \
        .write.mode("errorifexists").text(f"{root}/{COMMITS}/version={nxt:06d}")
    return path


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The current (highest committed) version of the collection."""
    v = current_version(spark, root)
    if v is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return spark.read.parquet(version_path(root, v))

"""A collection clustered by range, with postings of its lists.

``write`` lays a version out sorted over all files by its range columns
(``repartitionByRange`` + a sort inside files), so a range filter that reaches
the Parquet scan skips row groups by their statistics. A key that is frequent
in the first range column is split by the others.

Beside each version lie its postings, valid with the version's marker: one row
per list element with the element folded in case, the document's number in the
version, the element's place and the list's length. They are sorted by element
and document, so ``token IN (...)`` reaches the scan and reads few row groups,
however frequent a token is, and the documents are found by a semi join on
their number. Lists are counted from postings at place 0, without the documents.

Defined cases: a NULL or empty list has no postings; a NULL element has a
posting without a token (it counts in the list's length and is never found);
an element that occurs twice finds its document once; documents that are equal
or lack a key are told apart by their number. Tokens match when they are equal
after ``lower(upper(...))``. An empty collection gives empty results, a length
below 1 is refused (documents without elements have no postings), and a column
called ``_doc`` can't be stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import snapshot

DOC = "_doc"
_POSTINGS = "postings"


def fold(c: Column) -> Column:
    """The form in which tokens are compared."""
    return F.lower(F.upper(c))


def postings_of(docs: DataFrame, list_col: str) -> DataFrame:
    """token, ``_doc``, place, n (the list's length) for every list element."""
    return (docs.select(DOC, F.size(list_col).alias("n"), F.posexplode(list_col).alias("place", "token"))
            .select(fold(F.col("token")).alias("token"), DOC, "place", "n"))


def _named(c: str) -> str:
    return f"{_POSTINGS}-{c}"


def write(docs: DataFrame, root: str, range_cols: list[str], list_cols: list[str]) -> str:
    """K2/K3: the next version, clustered by ``range_cols`` (nested paths
    allowed), with postings of every column of ``list_cols``."""
    if DOC in docs.columns:
        raise ValueError(f"reserved column name: {DOC}")
    spark = docs.sparkSession
    clustered = docs.repartitionByRange(*range_cols).sortWithinPartitions(*range_cols)
    # The numbers are fixed once written: postings are made from the written version.
    numbered = clustered.withColumn(DOC, F.monotonically_increasing_id())

    def index(path: str, version: int) -> None:
        written = spark.read.parquet(path)
        for c in list_cols:
            (postings_of(written, c).repartitionByRange("token", DOC).sortWithinPartitions("token", DOC)
             .write.mode("overwrite").parquet(f"{root}/{_named(c)}/version={version:06d}"))

    return snapshot.write_snapshot(numbered, root, before_commit=index)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The documents of the current version."""
    return snapshot.read_snapshot(spark, root).drop(DOC)


def postings(spark: SparkSession, root: str, list_col: str) -> DataFrame:
    version = snapshot.current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return spark.read.parquet(f"{root}/{_named(list_col)}/version={version:06d}")


def with_any(spark: SparkSession, root: str, list_col: str, tokens: list[str], where: Column | None = None) -> DataFrame:
    """F4 + F6: documents whose list holds one of ``tokens`` and that satisfy
    ``where``, a filter that the scan of the documents receives."""
    docs = snapshot.read_snapshot(spark, root)
    folded = [r[0] for r in spark.createDataFrame([(t,) for t in tokens], "t string")
              .select(fold(F.col("t"))).distinct().collect()] if tokens else []       # the caller's own few tokens
    hits = postings(spark, root, list_col).where(F.col("token").isin(folded)).select(DOC)
    return (docs if where is None else docs.where(where)).join(hits, DOC, "left_semi").drop(DOC)


def count_at_least(spark: SparkSession, root: str, list_col: str, n: int, alias: str = "n_multi") -> DataFrame:
    """F3 + G1: number of documents whose list has at least ``n`` elements."""
    if n < 1:
        raise ValueError("postings know lists of at least one element")
    firsts = postings(spark, root, list_col).where((F.col("place") == 0) & (F.col("n") >= n))
    return firsts.agg(F.count(F.lit(1)).alias(alias))

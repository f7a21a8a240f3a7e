"""Multi-line CSV of other writers, read in splits.

A quoted cell may hold line breaks, so a split's reader can't tell whether its
first line begins a record: that depends on whether the quotes before it are
even or odd in number. Their parity is a prefix sum, taken in two levels:

1. the text scan cuts files into splits and lines; every split gives its
   number of lines, the parity of its quotes, and how many of its lines would
   begin a record if it were entered outside a quoted cell (entered inside, the
   others do). Only the parity of each line goes to the summing task;
2. a window over a file's splits gives each split the parity it is entered with
   and the records begun before it.

A second scan numbers the records. Lines of one record inside a batch are put
together there; pieces of records that cross a batch or a split (two or so for
each) are grouped by (file, record). Every record is then parsed by ``from_csv``.
So a file of any size is read by as many tasks as it has splits and no text but
the pieces is shuffled.

A quote counts wherever it stands: cells that hold quotes must be quoted, with
quotes doubled, as RFC 4180 writers do. A file whose quotes are odd in number
is refused. Line ends are those of the file's first line: where that is CR LF, a
CR before the LF that ends a record is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Splits (of ``spark.sql.files.maxPartitionBytes``) whose state is broadcast, about 200 bytes each.
BROADCAST_SPLITS = 100_000

_SPLIT = ["_file", "_block"]
_SUMMARY = "_file string, _block long, lines long, odd long, begun long, cr boolean"
_RECORDS = "_file string, _record long, _block long, _line long, crlf boolean, text string, whole boolean"
_PARSE = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_id"), (quotes % 2).cast("int").alias("q"), "value")


def _stretches(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The consecutive rows of one split."""
    new = (b["_file"] != b["_file"].shift()) | (b["_block"] != b["_block"].shift())
    edges = [*new.to_numpy().nonzero()[0].tolist(), len(b)]
    for s, e in zip(edges, edges[1:]):
        yield b.iloc[s:e]


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per split; a split's lines come together and in their order."""
    now = None
    for b in batches:
        for part in _stretches(b):
            key = (part["_file"].iat[0], part["_block"].iat[0])
            if now is None or now[:2] != key:
                if now is not None:
                    yield pd.DataFrame([now], columns=_columns(_SUMMARY))
                now = (*key, 0, 0, 0, bool(part["cr"].iat[0]))
            q = part["q"].to_numpy(dtype=np.int64)
            inside = (now[3] + q.cumsum() - q) % 2
            now = (*key, now[2] + len(q), (now[3] + int(q.sum())) % 2, now[4] + int((inside == 0).sum()), now[5])
    if now is not None:
        yield pd.DataFrame([now], columns=_columns(_SUMMARY))


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _split_states(lines: DataFrame) -> DataFrame:
    """For each split: ``entry`` (1: entered inside a quoted cell), ``base``
    (records begun before it), ``crlf`` of its file. One row per split; the
    window of a file holds its splits, not its lines."""
    found = materialize(lines.select(*_SPLIT, "q", F.endswith("value", F.lit("\r")).alias("cr"))
                        .mapInPandas(_summarise, _SUMMARY), "csv-splits")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    entered = found.select("*", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("entry"),
                           (F.sum("odd").over(whole) % 2).alias("open"), F.min_by("cr", "_block").over(whole).alias("crlf"))
    begun = F.when(F.col("entry") == 0, F.col("begun")).otherwise(F.col("lines") - F.col("begun"))
    return materialize(entered.withColumn("base", F.coalesce(F.sum(begun).over(before), F.lit(0)))
                       .select(*_SPLIT, "entry", "base", "crlf", "open"), "csv-states")


def _regroup(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records, and pieces of the records that cross a batch or a split."""
    key, parity, begun, line = None, 0, 0, 0
    for b in batches:
        for part in _stretches(b):
            if key != (here := (part["_file"].iat[0], part["_block"].iat[0])):
                key, parity, begun, line = here, int(part["entry"].iat[0]), int(part["base"].iat[0]), 0
            q = part["q"].to_numpy(dtype=np.int64)
            inside = (parity + q.cumsum() - q) % 2               # before each line
            after = (inside + q) % 2
            record = begun + (inside == 0).cumsum()
            first = np.concatenate([[0], np.diff(record).nonzero()[0] + 1])
            last = np.concatenate([first[1:], [len(q)]]) - 1
            whole = (inside[first] == 0) & (after[last] == 0)
            values = part["value"].to_numpy(dtype=object)
            text = values[first]
            for i in (last > first).nonzero()[0].tolist():
                text[i] = "\n".join(values[first[i]:last[i] + 1])
            yield pd.DataFrame({"_file": key[0], "_record": record[first], "_block": key[1], "_line": line + first,
                                "crlf": bool(part["crlf"].iat[0]), "text": text, "whole": whole})
            parity, begun, line = int(after[-1]), int(record[-1]), line + len(q)


def read_records(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """_file, _record (from 1 in each file, the header included), text of every
    record that isn't empty."""
    lines = _lines(spark, path)
    states = _split_states(lines)
    if bad := states.where("open = 1").limit(1).collect():
        raise ValueError(f"{bad[0]['_file']}: odd number of quotes; cells that hold quotes must be quoted")
    states = states.drop("open")
    if states.count() <= broadcast_splits:
        entered = lines.join(F.broadcast(states), _SPLIT)       # keeps the scan's order and partitions
    else:
        entered = lines.join(states, _SPLIT).repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "_id")
    found = materialize(entered.select(*_SPLIT, "entry", "base", "crlf", "q", "value")
                        .mapInPandas(_regroup, _RECORDS), "csv-records")
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_line", "text")))
    joined = (found.where("NOT whole").groupBy("_file", "_record")
              .agg(F.first("crlf").alias("crlf"), F.array_join(pieces["text"], "\n").alias("text")))
    text = F.when(F.col("crlf") & F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return (found.where("whole").select("_file", "_record", "crlf", "text").unionByName(joined)
            .select("_file", "_record", text.alias("text")).where("text <> ''"))


def read_foreign_csv(spark: SparkSession, path: str, columns: list[str], position: str | None = None,
                     broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """All-text rows of the CSV files under ``path`` (each with a header), equal
    to a whole-file multi-line read. ``position`` names a column for the rows'
    order: files by path, then records."""
    records = read_records(spark, path, broadcast_splits).where("_record > 1")
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    row = records.select("_file", "_record", F.from_csv("text", F.lit(schema), _PARSE).alias("_row"))
    cells = [F.col("_row")[c].alias(c) for c in columns]
    if position is None:
        return row.select(*cells)
    files = records.select("_file").distinct()                  # one row per file
    rank = files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_rank"))
    return row.join(rank, "_file").select(*cells, (F.col("_rank") * F.lit(1 << 40) + F.col("_record")).alias(position))

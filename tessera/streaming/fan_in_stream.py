"""Fan-in while replies arrive (J2 + G4 as a stream).

An item asks for one page per element of its list and is complete when every
reply is there. Events come in any order: the item itself (``names``, its list)
and its replies (``pos``, ``text``). State is kept per item: the names once
known, the replies so far, and a deadline, ``wait`` after the item's latest
event time. Items are dealt to ``BUCKETS`` by a hash, and one call handles a
bucket's events, since a call costs far more than an event. An item is emitted when its last reply arrives, or when the
watermark passes the deadline, with the fallback text for the replies that
never came. A state holds the pending items of one bucket, with a timer for the
first deadline among them, and lives in the query's checkpoint folder, which must be shared; it survives a restart between any two
batches.

Defined cases: an item without elements (NULL or empty list) is emitted at once
with an empty list; of several replies for one position the least text counts,
until the item is emitted; a reply without text counts as having come, with the
fallback text; replies for positions that the list doesn't have are ignored;
replies that come after their item was emitted, or whose item never comes, are
forgotten after ``wait``; a second item event is ignored while the first is
pending. Events without an item or a time, and those whose time lies more than
``lateness`` before the latest one of earlier batches, are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.enrich import MISSING_PAGE_TEXT

EVENTS = "item long, names array<string>, pos int, text string, at timestamp"
_OUT = "item long, list array<struct<name: string, text: string>>, n_missing int"
_STATE = "held string"                  # JSON: by item: names, replies by position, deadline in ms
BUCKETS = 8192                          # states, at most


def _emitted(done: list[tuple[int, dict]], fallback: str) -> pd.DataFrame:
    out = []
    for item, held in done:
        names, replies = held["names"], held["replies"]
        texts = [replies.get(str(i)) for i in range(len(names))]
        row = [{"name": n, "text": fallback if t is None else t} for n, t in zip(names, texts)]
        out.append((item, row, sum(str(i) not in replies for i in range(len(names)))))
    return pd.DataFrame(out, columns=["item", "list", "n_missing"])


def _add(held: dict[str, dict], events: pd.DataFrame, wait_ms: int) -> set[str]:
    """Adds the events to their items; gives the items that had any."""
    met = set()
    times = events["at"].to_numpy().astype("datetime64[ms]").astype("int64")
    for item, names, pos, text, at in zip(events["item"], events["names"], events["pos"], events["text"], times.tolist()):
        met.add(item := str(int(item)))
        own = held.get(item)
        if own is None:
            own = held[item] = {"names": None, "replies": {}, "deadline": 0}
        if pd.isna(pos):
            if own["names"] is None:
                own["names"] = [] if names is None else [None if x is None else str(x) for x in names]
        else:
            key, text = str(int(pos)), None if text is None or text is pd.NA else str(text)
            had = own["replies"].get(key)
            own["replies"][key] = min((x for x in (had, text) if x is not None), default=None)
        own["deadline"] = max(own["deadline"], at + wait_ms)
    return met


def fan_in_replies(events: DataFrame, wait_ms: int = 600_000, lateness: str = "0 seconds",
                   fallback: str = MISSING_PAGE_TEXT, buckets: int = BUCKETS) -> DataFrame:
    """item, list (name, text; in the list's order), n_missing of every item, in
    append mode. ``events`` is a streaming table with the columns of ``EVENTS``;
    an item event has no ``pos``. Works on event time, so a replay gives the same.
    ``buckets`` stays as it is for the life of a checkpoint."""

    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        now, met = state.getCurrentWatermarkMs(), set()
        if not state.hasTimedOut:
            for b in batches:
                met |= _add(held, b, wait_ms)
        done = []
        for item, own in list(held.items()):
            names, deadline = own["names"], own["deadline"]
            past = deadline < now or deadline == now and item in met
            whole = item in met and names is not None and all(str(i) in own["replies"] for i in range(len(names)))
            if past or whole:
                del held[item]
                if names is not None:
                    done.append((int(item), own))
        if done:
            yield _emitted(done, fallback)
        if not held:
            if state.exists:
                state.remove()
            return
        state.update((json.dumps(held),))
        state.setTimeoutTimestamp(min(own["deadline"] for own in held.values()))

    timed = events.where("item IS NOT NULL AND at IS NOT NULL").withWatermark("at", lateness)
    return (timed.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets))).groupBy("bucket")
            .applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout))


def run_available(events: DataFrame, out: str, checkpoint_location: str, **options) -> None:
    """Handle all events that are there now; items go to Parquet files under ``out``
    (each once, also after a restart)."""
    query = (fan_in_replies(events, **options).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start(out))
    query.awaitTermination()


def end_of_time(spark, after: str) -> DataFrame:
    """A single event that belongs to no waiting item and moves the watermark to
    ``after``, for a source that has ended."""
    return spark.range(1).select(F.lit(-1).cast("long").alias("item"), F.lit(None).cast("array<string>").alias("names"),
                                 F.lit(0).alias("pos"), F.lit(None).cast("string").alias("text"),
                                 F.lit(after).cast("timestamp").alias("at"))

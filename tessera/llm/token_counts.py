"""Token counts by a compiled finite-state transducer.

The word-level BPE drops white space and never merges across it, so its
tokenizer is a transducer over bytes with a reset on every ASCII blank: the
word read so far is the state, and the transition on a blank (or the end)
emits the word's token count. ``WordTransducer`` compiles those transitions
from the tokenizer itself, each distinct word once, into a bounded table.

A text is read in chunks of fixed size that know nothing of each other. The
state map of a chunk says for any entry state (any unfinished word) what it
emits and in which state it leaves: ``head`` is what it adds to the entry
word, ``emitted`` the count of the words that lie inside, ``tail`` the
unfinished word at its end. Maps compose associatively, so a text of any
length is reduced by a parallel prefix scan (pairwise, in log depth).

Blanks inside the tokenizer's own white space that aren't ASCII are part of a
word here and left to the tokenizer; special strings hold no blanks and are
counted as it counts them by default.

Defined cases: NULL text counts as empty (0 tokens, 0 bytes); every row gives a
row, repeated ones too; NULL doc_id stays NULL; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16                # bytes
TABLE_WORDS = 1_000_000        # compiled words per Python worker, then started anew
_BLANKS = b" \t\n\r\x0b\x0c"


class StateMap(NamedTuple):
    """A chunk as a function of its entry word; ``resets``: it holds a blank."""

    resets: bool
    head: bytes
    emitted: int
    tail: bytes


class WordTransducer:
    _made: dict[str, WordTransducer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.emits: dict[bytes, int] = {b"": 0}

    @classmethod
    def of(cls, path: str) -> WordTransducer:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def emission(self, words: list[bytes]) -> int:
        """Sum of the words' counts; compiles those that are new."""
        table = self.emits
        new = list({w for w in words if w not in table})
        if new:
            if len(table) + len(new) > TABLE_WORDS:
                table.clear()
                table[b""] = 0
                new = list(set(words) - {b""})
            texts = [w.decode("utf-8") for w in new]
            for w, e in zip(new, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                table[w] = len(e.ids)
        return sum(map(table.__getitem__, words))

    def state_map(self, chunk: bytes) -> StateMap:
        words = chunk.split()
        if not words:
            return StateMap(bool(chunk), b"", 0, b"")
        head = b"" if chunk[0] in _BLANKS else words.pop(0)
        if len(head) == len(chunk):
            return StateMap(False, head, 0, b"")
        tail = b"" if chunk[-1] in _BLANKS else words.pop()
        return StateMap(True, head, self.emission(words), tail)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if not b.resets:
            return StateMap(True, a.head, a.emitted, a.tail + b.head) if a.resets \
                else StateMap(False, a.head + b.head, 0, b"")
        if not a.resets:
            return StateMap(True, a.head + b.head, b.emitted, b.tail)
        return StateMap(True, a.head, a.emitted + self.emission([a.tail + b.head]) + b.emitted, b.tail)

    def count(self, text: bytes, chunk: int = CHUNK) -> int:
        """Tokens of a text from the empty entry state."""
        maps = [self.state_map(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i]
                    for i in range(0, len(maps), 2)]
        if not maps:
            return 0
        m = maps[0]
        return self.emission([m.head, m.tail]) + m.emitted


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = WordTransducer.of(tokenizer)
        for b in batches:
            counts = [machine.count(t.encode("utf-8"), chunk) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "n_bytes": b["n_bytes"], "n_tokens": counts})

    text = F.coalesce("text", F.lit(""))
    counted = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                           F.octet_length(text).cast("long").alias("n_bytes"))
               .mapInPandas(run, "doc_id long, n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""License scan by a positional rare-token index; DataFrame functions only.

A template is a known notice with mandatory phrases. Of its words, those outside
``EVERYDAY`` are licence words. Method:

1. One pass over the texts keeps of every file the places of its licence words
   and of the templates' phrases (a phrase is sought at the places of its first
   licence word only, and compared word by word).
2. Files that hold a licence word are counted (as many counts as the templates
   have words), which gives the words' IDF. The index lists, for the ``RARE``
   words of highest IDF of each template, their positions in it.
3. A file's places of indexed words are joined to the index; file position less
   template position is an offset. Offsets on which ``VOTES`` positions agree
   (all, for templates with fewer) are alignments.
4. An alignment is verified if each mandatory phrase of its template stands in
   the file within ``SHIFT`` words of the place that the offset foretells. Its
   share is that of the template's licence words which stand in their places.

Scale: files are independent until step 3, whose rows are licence words only;
they are counted by (file, template, offset), so a word or notice that a third
of the files hold adds rows, never a large group. What is broadcast is the
index, whose size the templates bound. The texts are read once.

Defined cases: NULL text is the empty text; every row gives a row, repeated ones
too; NULL doc_id stays NULL; a file may have several alignments, labels are
distinct; an empty table gives no rows; columns besides doc_id and text are not
read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, materialize, text_of

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE, VOTES, SHIFT = 8, 3, 20

# Words too common to tell a licence by.
EVERYDAY = frozenset(
    "0 1 2 3 4 a all an and any are as at basis be but by can do either even file following for form forms from if in is it "
    "kind later list met must no not obtain of on one option or org other out person persons portions so source that the "
    "their this to under use was were what when which will with without work you your http https www".split())


class Template(NamedTuple):
    name: str
    label: str
    text: str                       # lower-case words, one blank between two
    phrases: tuple[str, ...]        # of the text, all mandatory


# Notices of common licences, in words. Those named base are the phrases that every report counts.
BASE = (
    Template("mit license", "mit", "mit license", ("mit license",)),
    Template("apache license", "apache", "apache license", ("apache license",)),
    Template("general public license", "gpl", "general public license", ("general public license",)),
)
TEMPLATES = (
    *BASE,
    Template("mit grant", "mit",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation the "
             "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
             "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
             "notice and this permission notice shall be included in all copies or substantial portions of the software",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("apache notice", "apache",
             "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
             "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
             "under the license is distributed on an as is basis without warranties or conditions of any kind either express "
             "or implied see the license for the specific language governing permissions and limitations under the license",
             ("except in compliance with the license", "unless required by applicable law or agreed to in writing")),
    Template("gpl notice", "gpl",
             "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
             "license as published by the free software foundation either version 3 of the license or at your option any "
             "later version this program is distributed in the hope that it will be useful but without any warranty without "
             "even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
             "license for more details", ("under the terms of the gnu general public license",)),
    Template("lgpl notice", "lgpl",
             "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
             "public license as published by the free software foundation",
             ("under the terms of the gnu lesser general public license",)),
    Template("agpl notice", "agpl",
             "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
             "by the free software foundation", ("gnu affero general public license",)),
    Template("bsd conditions", "bsd",
             "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met redistributions of source code must retain the above copyright notice this list "
             "of conditions and the following disclaimer",
             ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("isc grant", "isc",
             "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted provided that the above copyright notice and this permission notice appear in all copies",
             ("for any purpose with or without fee is hereby granted",)),
    Template("mozilla notice", "mpl",
             "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
             "distributed with this file you can obtain one at", ("mozilla public license",)),
    Template("unlicense", "unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
    Template("bsd license", "bsd", "bsd license", ("bsd license",)),
    Template("bsd clause license", "bsd", "bsd 3 clause license", ("bsd 3 clause license",)),
    Template("mozilla license", "mpl", "mozilla public license", ("mozilla public license",)),
    Template("lesser license", "lgpl", "lesser general public license", ("lesser general public license",)),
    Template("affero license", "agpl", "affero general public license", ("affero general public license",)),
    Template("cc by", "cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc by sa", "cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc by nc", "cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc by nc sa", "cc-by-nc-sa", "licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    Template("cc by nd", "cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template("cc zero", "cc0", "cc0 1 0 universal", ("cc0 1 0 universal",)),
    Template("cc attribution", "cc-by", "creative commons attribution 4 0 international license",
             ("creative commons attribution 4 0",)),
    Template("cc attribution sharealike", "cc-by-sa", "creative commons attribution sharealike 4 0 international license",
             ("creative commons attribution sharealike 4 0",)),
    Template("cc attribution noncommercial", "cc-by-nc", "creative commons attribution noncommercial 4 0 international license",
             ("creative commons attribution noncommercial 4 0",)),
)


class _Phrase(NamedTuple):
    words: tuple[str, ...]
    head: str               # its first licence word
    lead: int               # words before the head


def _phrase(text: str) -> _Phrase:
    words = tuple(text.split())
    lead = next(i for i, w in enumerate(words) if w not in EVERYDAY)
    return _Phrase(words, words[lead], lead)


def _find(words: list[str], part: tuple[str, ...]) -> int:
    return next(i for i in range(len(words)) if tuple(words[i:i + len(part)]) == part)


class Library:
    """Templates as word positions and phrases."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES):
        self.templates = templates
        self.words = [[(i, w) for i, w in enumerate(t.text.split()) if w not in EVERYDAY] for t in templates]
        self.vocabulary = sorted({w for ws in self.words for _, w in ws})
        self.phrases = sorted({p for t in templates for p in t.phrases})
        self.at = [[(self.phrases.index(p), _find(t.text.split(), tuple(p.split()))) for p in t.phrases] for t in templates]


def _rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants."""
    names, kinds = zip(*[c.split() for c in schema.split(", ")])
    structs = [F.struct(*[F.lit(v).cast(k).alias(n) for n, k, v in zip(names, kinds, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def files_of(docs: DataFrame, library: Library) -> DataFrame:
    """doc_id, n_words, marks (pos, word) of licence words, places (phrase,
    start) of all phrases, of every row."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower_ascii(text_of()).alias("_text"))
    words = text.select("doc_id", F.regexp_extract_all("_text", F.lit(f"({WORDS})"), F.lit(1)).alias("_words"))
    marks = F.filter(F.transform("_words", lambda w, i: F.struct(i.cast("long").alias("pos"), w.alias("word"))),
                     lambda x: x["word"].isin(library.vocabulary))
    marked = words.select("doc_id", "_words", F.size("_words").cast("long").alias("n_words"), marks.alias("marks"))

    def places(k: int, p: _Phrase) -> Column:
        def stands(x: Column) -> Column:
            return (x["word"] == p.head) & F.when(x["pos"] >= p.lead, F.slice(
                F.col("_words"), (x["pos"] + 1 - p.lead).cast("int"), len(p.words)) == F.array(*map(F.lit, p.words))).otherwise(False)
        return F.transform(F.filter("marks", stands), lambda x: F.struct(F.lit(k).alias("phrase"), (x["pos"] - p.lead).alias("start")))

    found = [places(k, _phrase(p)) for k, p in enumerate(library.phrases)]
    none = F.array().cast("array<struct<phrase: int, start: long>>")
    return marked.select("doc_id", "n_words", "marks", F.when(F.size("marks") > 0, F.concat(*found)).otherwise(none).alias("places"))


def rare_index(files: DataFrame, library: Library, rare: int = RARE) -> list[list[tuple[int, str]]]:
    """For each template, (position, word) of its ``rare`` words of highest IDF
    in the files (ties: by word). Collects a count per licence word."""
    counted = (files.select(F.explode(F.array_distinct(F.col("marks")["word"])).alias("word"))
               .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())
    n = {r["word"]: r["n"] for r in counted}
    index = []
    for words in library.words:
        least = set(sorted({w for _, w in words}, key=lambda w: (n.get(w, 0), w))[:rare])
        index.append([(i, w) for i, w in words if w in least])
    return index


def alignments(files: DataFrame, library: Library, rare: int = RARE, votes: int = VOTES, shift: int = SHIFT) -> DataFrame:
    """_row, template, label, offset, votes, share, verified: where templates lie
    in files. ``files`` as from ``files_of``, written, with a number ``_row``."""
    spark = files.sparkSession
    index = rare_index(files, library, rare)
    postings = _rows(spark, [(t, i, w, min(votes, len(part))) for t, part in enumerate(index) for i, w in part],
                     "template int, at long, word string, need long")
    looked_up = sorted({w for part in index for _, w in part})
    hits = (files.select("_row", F.explode(F.filter("marks", lambda x: x["word"].isin(looked_up))).alias("m"))
            .select("_row", "m.pos", "m.word"))
    agreed = (hits.join(F.broadcast(postings), "word")
              .groupBy("_row", "template", (F.col("pos") - F.col("at")).alias("offset"))
              .agg(F.count(F.lit(1)).alias("votes"), F.first("need").alias("need"))
              .where("votes >= need").drop("need"))
    known = _rows(spark, [(t, x.name, x.label) for t, x in enumerate(library.templates)], "template int, name string, label string")
    marks = F.transform("marks", lambda x: F.struct((x["pos"] - F.col("offset")).alias("pos"), x["word"].alias("word")))
    share, verified = F.lit(0.0), F.lit(False)
    for t, words in enumerate(library.words):
        own = F.array(*[F.struct(F.lit(i).cast("long").alias("pos"), F.lit(w).alias("word")) for i, w in words])
        here = F.col("template") == t
        share = F.when(here, F.size(F.array_intersect(marks, own)) / F.lit(len(words))).otherwise(share)
        stand = F.lit(True)
        for k, at in library.at[t]:
            stand &= F.exists("places", lambda x: (x["phrase"] == k) & (F.abs(x["start"] - at - F.col("offset")) <= shift))  # noqa: B023
        verified = F.when(here, stand).otherwise(verified)
    return (agreed.join(files.select("_row", "marks", "places"), "_row").join(F.broadcast(known), "template")
            .select("_row", F.col("name").alias("template"), "label", "offset", "votes",
                    share.alias("share"), verified.alias("verified")))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """The files of ``docs`` with a number ``_row`` (written once) and their alignments."""
    library = Library(templates)
    files = materialize(files_of(docs, library).withColumn("_row", F.monotonically_increasing_id()), "licence-files")
    return files, alignments(files, library)


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    of every row; score is the greatest share of an alignment (1 where a base
    phrase stands, 0 without alignments)."""
    files, aligned = scan(docs)
    phrases = Library().phrases
    number = {phrases.index(t.phrases[0]): t.label for t in BASE}
    base = F.filter("places", lambda x: x["phrase"].isin(list(number)))
    files = files.select("_row", "doc_id", "n_words", base.alias("base"))
    label = F.lit(None).cast("string")

    def label_of(x: Column) -> Column:
        out = label
        for k, name in number.items():
            out = F.when(x["phrase"] == k, F.lit(name)).otherwise(out)
        return out

    found = aligned.groupBy("_row").agg(
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("more"), F.max("share").alias("share"))
    starts = F.col("base")["start"]
    base_labels = F.array_distinct(F.transform("base", label_of))
    more = F.coalesce("more", F.array().cast("array<string>"))
    return files.join(found, "_row", "left").select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, more)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))

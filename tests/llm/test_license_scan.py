import random
import re

import pytest

from tessera.llm import license_scan as ls

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(ls.WORDS, text)


def base_of(text):
    words = words_of(text)
    hits = sorted((i, label) for p, label in PHRASES.items() for k in [p.split()]
                  for i in range(len(words) - len(k) + 1) if words[i:i + len(k)] == k)
    return (len(words), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None,
            ",".join(sorted({label for _, label in hits})))


def plain_alignments(texts, library, rare=ls.RARE, votes=ls.VOTES, shift=ls.SHIFT):
    """Every offset of every template against every file."""
    files = [words_of(t) for t in texts]
    df = {w: sum(w in f for f in files) for w in library.vocabulary}
    out = set()
    for t, (template, marks) in enumerate(zip(library.templates, library.words)):
        chosen = set(sorted({w for _, w in marks}, key=lambda w: (df[w], w))[:rare])
        index = [(i, w) for i, w in marks if w in chosen]
        for row, words in enumerate(files):
            for offset in range(-60, len(words)):
                agree = sum(0 <= offset + i < len(words) and words[offset + i] == w for i, w in index)
                if agree < min(votes, len(index)):
                    continue
                stand = sum(0 <= offset + i < len(words) and words[offset + i] == w for i, w in marks)
                ok = all(any(words[s:s + len(p)] == p and abs(s - at - offset) <= shift for s in range(len(words)))
                         for k, at in library.at[t] for p in [library.phrases[k].split()])
                out.add((row, template.name, template.label, offset, agree, round(stand / len(marks), 9), ok))
    return out


def texts_():
    r, out = random.Random(4), ["", " ", "MIT License", "mit-LICENSE mit license Apache License", "The MİT licence", "mit mit license license"]
    for t in ls.TEMPLATES:
        words = t.text.split()
        out += [t.text.upper() + ".", "so " * 7 + t.text.replace(" ", ", ") + " by x", " ".join(words[len(words) // 2:])]
        for _ in range(2):
            w = list(words)
            for _ in range(r.randrange(1, 4)):
                k = r.randrange(len(w))
                w[k:k + r.randrange(2)] = ["x"] * r.randrange(2)
            out.append("/* " + " ".join(w) + " */ " + " ".join(r.choice(ls.TEMPLATES[3].text.split()) for _ in range(30)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, t, i) for i, t in enumerate(texts_())], "doc_id long, text string, template int")


def test_alignments_equal_all_offsets(spark, table):
    files, aligned = ls.scan(table)
    ids = {r["_row"]: r["doc_id"] for r in files.select("_row", "doc_id").collect()}
    got = {(ids[r["_row"]], r["template"], r["label"], r["offset"], r["votes"], round(r["share"], 9), r["verified"])
           for r in aligned.collect()}
    assert got == plain_alignments(texts_(), ls.Library())


def test_report(spark, table):
    got = {r["doc_id"]: r for r in ls.license_report(table).collect()}
    texts = texts_()
    assert len(got) == len(texts)
    want = plain_alignments(texts, ls.Library())
    for i, t in enumerate(texts):
        r = got[i]
        n_words, n_base, first, last, base = base_of(t)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n_words, n_base, first, last, base)
        labels = set(filter(None, base.split(","))) | {x[2] for x in want if x[0] == i and x[6]}
        assert r["labels"] == ",".join(sorted(labels))
        share = max([x[5] for x in want if x[0] == i], default=0)
        assert r["score"] == pytest.approx(1 if n_base else share, abs=1e-8)


def test_whole_notices_are_found(spark, table):
    labels = {r["doc_id"]: r["labels"].split(",") for r in ls.license_report(table).collect()}
    for k, t in enumerate(ls.TEMPLATES):
        assert t.label in labels[6 + 5 * k] and t.label in labels[7 + 5 * k]


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted((tuple(r) for r in ls.license_report(odd_docs).collect()), key=str)
    want = sorted(((r.doc_id, *base_of(r.text), "", 0.0) for r in odd_docs.collect()), key=str)
    assert got == want
    assert ls.license_report(no_docs).collect() == []


def test_no_python_in_the_plan(table):
    plan = ls.license_report(table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)

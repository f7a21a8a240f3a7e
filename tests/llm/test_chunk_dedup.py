import random

from tessera.llm import chunk_dedup as cd


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))


def test_chunks_cover_the_text_and_resist_insertions():
    a = prose(2000, 1).encode()
    ends = cd.borders(a)
    sizes = [e - s for s, e in zip([0, *ends], ends)]
    assert ends[-1] == len(a) and max(sizes) <= cd.MAX_CHUNK + cd.MIN_CHUNK and min(sizes) >= cd.MIN_CHUNK
    b = a[:500] + b" inserted" + a[500:]
    own = {a[s:e] for s, e in zip([0, *ends], ends)}
    eb = cd.borders(b)
    assert sum(b[s:e] in own for s, e in zip([0, *eb], eb)) > 0.9 * len(eb)
    assert cd.borders(b"") == [] and cd.borders(b"ab") == [2]


def test_passages_are_caught_and_clean_rows_left_alone(spark):
    passage = prose(70, 99)
    rows = [(i, prose(60, i) + " " + passage + " " + prose(40, 1000 + i)) for i in range(20)]
    rows += [(100 + i, prose(120, 2000 + i)) for i in range(50)]
    rows += [(200, rows[60][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in cd.chunk_report(docs).collect()}
    assert all(got[i].repeated for i in range(20)) and got[200].repeated
    assert [i for i in range(100, 150) if got[i].repeated] == [rows[60][0]]
    assert got[0].dropped_bytes == 0 and all(got[i].dropped_bytes > 200 for i in range(1, 20))
    assert got[200].dropped_bytes == got[200].n_bytes
    out = {r.doc_id: r.text for r in cd.dedup_chunks(docs).collect()}
    for d, t in rows:
        raw, keep, at = t.encode(), [], 0
        for s in got[d].spans:
            keep.append(raw[at:s.start])
            at = s.end
        assert out[d] == b"".join([*keep, raw[at:]]).decode("utf-8", "ignore")


def test_spans_against_brute_force(spark):
    rows = [(i, " ".join([prose(30, i % 7), prose(30, 50 + i), *[prose(20, 90 + i)] * 3])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first, holders = {}, {}
    for d, t in rows:
        raw, at = t.encode(), 0
        for e in cd.borders(raw):
            first.setdefault(raw[at:e], (d, at))
            holders.setdefault(raw[at:e], set()).add(d)
            at = e
    for r in cd.chunk_report(docs).collect():
        raw, at, marks = dict(rows)[r.doc_id].encode(), 0, []
        for e in cd.borders(raw):
            if len(holders[raw[at:e]]) > 1 and first[raw[at:e]] != (r.doc_id, at):
                marks.append((at, e - at))
            at = e
        assert [(s.start, s.end) for s in r.spans] == cd.runs(marks, cd.MIN_BYTES)


def test_odd_rows(odd_docs, no_docs):
    assert cd.chunk_report(odd_docs).count() == odd_docs.count()
    out = cd.dedup_chunks(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count() and out.where("text is null").count() == 1
    assert out.where("doc_id = 5").select("text").distinct().count() == 1 and out.where("doc_id = 5 and text = ''").count() == 0
    assert cd.chunk_report(no_docs).count() == 0 and cd.dedup_chunks(no_docs).count() == 0


def test_passages_of_51_words_are_met():
    r = random.Random(5)
    for i in range(400):
        passage = prose(51, i)
        a, b = ((prose(40, r.random()) + " " + passage + " " + prose(40, r.random())).encode() for _ in range(2))
        ea, eb = cd.borders(a), cd.borders(b)
        own = {a[s:e] for s, e in zip([0, *ea], ea)}
        assert cd.runs([(s, e - s) for s, e in zip([0, *eb], eb) if b[s:e] in own], cd.MIN_BYTES), i


def test_repeats_inside_one_document(spark):
    text = " ".join([prose(60, 1), *[prose(60, 2)] * 3, prose(60, 3)])
    docs = spark.createDataFrame([(1, text), (1, text), (2, prose(200, 4))], "doc_id long, text string")
    got = sorted(map(tuple, cd.chunk_report(docs, inside=True).select("doc_id", "repeated", "dropped_bytes").collect()))
    size = len(prose(60, 2)) + 1
    assert got[0] == got[1] and got[0][1] and 2 * size - 100 < got[0][2] <= 2 * size and got[2] == (2, False, 0)
    assert len(cd.dedup_chunks(docs, inside=True).where("doc_id = 1").first()["text"]) == len(text) - got[0][2]

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import periodic_runs as pr


def brute(words, least=6, times=4):
    """All periods against all stretches, smallest periods only."""
    n, out = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                out.setdefault((i, j + p), p)           # the smallest period comes first
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


@given(st.lists(st.sampled_from("ab"), max_size=70) | st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=600, deadline=None)
def test_few_words(words):
    assert pr.runs_of(words) == brute(words)


@given(st.data())
@settings(max_examples=400, deadline=None)
def test_planted_runs(data):
    words = []
    for _ in range(data.draw(st.integers(1, 5))):
        root = data.draw(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=9))
        times = data.draw(st.integers(1, 9))
        rest = data.draw(st.integers(0, len(root)))
        words += root * times + root[:rest]
        words += data.draw(st.lists(st.sampled_from("abcdefghij"), max_size=4))
    words *= data.draw(st.integers(1, 3))
    assert pr.runs_of(words) == brute(words)


def test_structured_words():
    fib, thue = ["a", "ab"], "a"
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    while len(thue) < 300:
        thue += thue.translate(str.maketrans("ab", "ba"))
    r = random.Random(3)
    period = [r.choice("abcdefghijklmnop") for _ in range(90)]
    for words in (list(fib[-1]), list(thue), list("a" * 500), list(("a" * 20 + "b") * 15), period * 5 + period[:17],
                  list("abc" * 3 + "ab"), list("aaaaa"), list("aaaaaa"), []):
        assert pr.runs_of(words) == brute(words)


def test_long_texts_stay_fast():
    r = random.Random(5)
    period = [f"w{r.randrange(500)}" for _ in range(7000)]
    words = [f"w{r.randrange(3000)}" for _ in range(20_000)] + period * 5
    assert [x[1:] for x in pr.runs_of(words)][-1:] == [(35_000, 7000)]
    assert pr.runs_of(["a"] * 300_000) == [(0, 300_000, 1)]


def test_the_grammar_gives_its_text_back():
    r = random.Random(1)
    ids = [r.randrange(3) for _ in range(400)]
    g = pr.Grammar(ids, [(0, 150), (170, 400)])

    def spelled(x):
        return [x] if x < g.base else spelled(g.rules[x - g.base][0]) + spelled(g.rules[x - g.base][1])

    got = [[w for s in symbols for w in spelled(s)] for symbols, _ in g.remains()]
    assert got == [ids[:150], ids[170:]]
    for k, (n, place) in enumerate(zip(g.lengths, g.places)):
        assert spelled(g.base + k) == ids[place:place + n]


def report_of(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    keep = [w for i, w in enumerate(words) if not any(s + p <= i < s + k for s, k, p in runs)]
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(keep)).hexdigest())


def test_report(spark, no_docs):
    r = random.Random(7)
    rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randrange(90))) + "\n x y" * r.randrange(9)) for i in range(120)]
    rows += [(None, "a b " * 8), (3, None), (4, ""), (5, "x " * 6), (5, "x " * 6), (10**15, " \t\r\n")]
    docs = spark.createDataFrame([(*x, 1, None) for x in rows], "doc_id long, text string, runs int, collapsed string")
    got = sorted((tuple(x) for x in pr.run_report(docs).collect()), key=str)
    assert got == sorted((report_of(*x) for x in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(120))
    assert pr.run_report(no_docs).count() == 0


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        pr.runs_of(list("ababab"), 6, 3)

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import token_counts

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.text(alphabet=st.sampled_from(list("aAb'st.9 \n\x1c\u00a0ée\u0301ΣßI")), max_size=80), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_chunks_of_any_size_count_as_the_library(text, chunk):
    machine = token_counts.WordTransducer.of(PATH)
    want = len(machine.tokenizer.encode(text, add_special_tokens=False).ids)
    assert machine.count(text.encode(), chunk) == want


def test_maps_compose_associatively():
    machine = token_counts.WordTransducer.of(PATH)
    a, b, c = (machine.state_map(x) for x in (b"he", b"llo wor", b"ld again "))
    assert machine.compose(machine.compose(a, b), c) == machine.compose(a, machine.compose(b, c))


def test_rows(spark, odd_docs, no_docs):
    t = tokenizers.Tokenizer.from_file(PATH)
    want = sorted(((r.doc_id, len((r.text or "").encode()), n, n > 100) for r in odd_docs.collect()
                   for n in [len(t.encode(r.text or "", add_special_tokens=False).ids)]), key=str)
    got = token_counts.count_tokens(odd_docs, PATH, limit=100, chunk=1000).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert token_counts.count_tokens(no_docs, PATH).count() == 0

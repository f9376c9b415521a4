import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyroll.llm import tokens

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def starts_of(text):
    return [s for s, _ in TOKENIZER.encode(text, add_special_tokens=False).offsets]


ALPHABET = st.sampled_from(list("ab Z1'!\n\t é字😀 \x1ć") + ["  ", "'s", "<|endoftext|>", " the"])


@given(st.lists(ALPHABET, max_size=80).map("".join), st.integers(3, 12), st.integers(1, 3))
@settings(max_examples=300, deadline=None)
def test_chunks_and_units_count_as_the_library(text, chunk, overlap):
    assert tokens.count_by_chunks(text, starts_of, chunk, overlap) == library(text)
    if text:
        assert tokens._UnitCounts(TOKENIZER).counts([text]) == [library(text)]


def counted(df, **options):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(df, **options).collect()), key=repr)


def expected(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    return sorted(((i, len(t.encode()), n := library(t), n > 512) for i, t in rows), key=repr)


def test_given_documents(documents):
    assert counted(documents) == expected(documents)
    assert counted(documents, chunk=700, overlap=20) == expected(documents)


def test_awkward_rows(awkward, no_docs):
    assert counted(awkward) == expected(awkward)
    assert counted(no_docs) == []

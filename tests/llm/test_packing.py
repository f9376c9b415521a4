from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyroll.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(df, capacity=2048):
    rows = packing.pack(df, capacity=capacity, keep_ids=True).collect()
    documents = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    wanted = []
    for doc_id, text in documents:
        ids = [*TOKENIZER.encode(text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            wanted.append((doc_id, piece, at, len(part) // 4, crc32(part), part))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return rows, sequences


PARTS = st.sampled_from(["a", "Zz", "é", "e\u0301", "ß", "İ", "Σ", "²", "7", "the", "ing", ".", "'", "'s", ",", "###", "<|endoftext|>", "\x1c", "\xa0", "字", "_", "-", " ", "\n"])


@given(st.lists(PARTS, max_size=40).map("".join))
@settings(max_examples=500, deadline=None)
def test_ids_of_words_are_those_of_the_text(text):
    words = packing._words_of(public_tokenizers.path("word_bpe_49k.json"))
    got = np.frombuffer(words.ids([text.encode()])[0], "<u4").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_letters_that_change_in_composing_or_lower_case():
    """Every letter of the basic plane before several marks and signs."""
    words = packing._words_of(public_tokenizers.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x10000) if chr(c).isalpha() and not 0x4E00 <= c < 0xD7A4]
    texts = [f"{c}{sign}" for c in letters for sign in (".", "!x", "'s", "\u0301", "9")]
    for at in range(0, len(texts), 4000):
        part = texts[at : at + 4000]
        wanted = [e.ids for e in TOKENIZER.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(i, "<u4").tolist() for i in words.ids([t.encode() for t in part])] == wanted


def best_fit(lengths, capacity):
    """The number of sequences of plain best-fit decreasing."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        gap = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def test_given_documents(documents):
    rows, sequences = check(documents)
    lengths = [r["length"] for r in rows]
    assert len(sequences) == best_fit(lengths, 2048)
    assert len(sequences) <= sum(lengths) / 2048 * 1.02 + 1


def test_small_capacity_and_awkward_rows(awkward, small_documents, no_docs):
    check(awkward)
    rows, sequences = check(small_documents, 64)
    assert len(sequences) == best_fit([r["length"] for r in rows], 64)
    assert check(no_docs)[0] == []


def test_runs_equal_plain_best_fit():
    rng = np.random.default_rng(5)
    for capacity in (7, 50, 300):
        for _ in range(40):
            lengths = rng.integers(1, capacity + 1, rng.integers(1, 200)).tolist()
            counts = {n: lengths.count(n) for n in lengths}
            _, sequences = packing.match_lengths(counts, capacity)
            assert sequences == best_fit(lengths, capacity)

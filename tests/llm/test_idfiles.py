import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from tallyroll.llm import idfiles
from tallyroll.llm.queries import QUERIES

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    """(doc_id, n, checksum) by the library alone, in order."""
    out = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, idfiles.END_ID], "<u4")
        out.append((doc_id, len(ids), crc32(ids.tobytes())))
    return out


def test_given_documents_against_the_library(spark, sf_dir, documents, tokenizer):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in QUERIES["op12_token_id_files"](spark, sf_dir).collect())
    want, start = [], 0
    for doc_id, n, check in expected(tokenizer, rows):
        want.append((doc_id, start, n, check))
        start += n
    assert got == want


def test_texts_of_all_kinds_have_the_ids_of_the_library(tokenizer):
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "\n\n", " \n", "\t", "word", "Über", "it's", "'S", "x'", "(a", "b)", "...", "12", "3a", "é́", "İ"]
    pieces += ["日本語", "नमस्ते", " ", " ", "\x1c", "<|endoftext|>", "<|", "endoftext", "²", "😀", "\r\n", "'ll", "#", "A\nB", "z,\ny", "͸", "ĳ"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(6000)]
    texts += [" ".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(2000)]
    ids = idfiles.TextIds(PATH)
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        for text, got in zip(part, ids.ids(part)):
            assert np.frombuffer(got, ids.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_are_spelled_for_the_model_without_cutting_them_again(tokenizer, monkeypatch):
    """Simple texts never go through the whole tokenizer, whose second cutting of every new word took half the time."""
    ids = idfiles.TextIds(PATH)
    monkeypatch.setattr(ids, "_encode", lambda texts: pytest.fail("encoded whole") if texts else [])
    words = "".join(map(chr, range(0xC0, 0x2B0))).replace("×", " ").replace("÷", " ")
    texts = [words, "Änderung des Été's don't 12,5%\n\n (a)\t b  c\r\n", " x", "\n", "zq" * 400, "", "~!{|} `_^"]
    assert [np.frombuffer(i, ids.kind).tolist() for i in ids.ids(texts)] == [tokenizer.encode(t).ids for t in texts]


def test_pretokens_are_looked_up_once_also_if_some_are_new(tokenizer):
    """Texts with new words, which most have, were read three times: for known ids, for the new words, and again for all ids."""

    class Counted(list):
        reads = 0

        def __iter__(self):
            self.reads += 1
            return super().__iter__()

    ids = idfiles.TextIds(PATH)
    for text in ("one two three, four", "two five, four", "two five, four"):
        parts = Counted(ids._cut(text))
        assert np.frombuffer(ids._joined([parts])[0], ids.kind).tolist() == tokenizer.encode(text).ids
        assert parts.reads == 1
    assert ids._joined([None, []]) == [None, b""]


def test_other_cutters_encode_new_words_whole(tmp_path):
    """A tokenizer that does more before its model than spell bytes gives the ids of the library too."""
    changed = Tokenizer.from_file(PATH)
    changed.normalizer = normalizers.Lowercase()
    changed.save(str(tmp_path / "lower.json"))
    ids = idfiles.TextIds(str(tmp_path / "lower.json"))
    assert ids.spelling is None
    texts = ["One TWO three's", "x\n\ny", "日 B"]
    assert [np.frombuffer(i, ids.kind).tolist() for i in ids.ids(texts)] == [changed.encode(t).ids for t in texts]


def test_a_full_memory_forgets_and_learns_again(tokenizer, monkeypatch):
    monkeypatch.setattr(idfiles, "_KNOWN_UNITS", 3)
    monkeypatch.setattr(idfiles, "_KNOWN_PARTS", 3)
    ids = idfiles.TextIds(PATH)
    for turn in range(4):
        for text in ("one two three, four", "five six\nseven (eight)", "one five nine ten"):
            assert np.frombuffer(ids.ids([text])[0], ids.kind).tolist() == tokenizer.encode(text).ids


@pytest.mark.parametrize("planes", ["bytes", "bits"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_there_and_back(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    table = idfiles.to_planes(ids, planes)
    assert len(table) == idfiles.PLANES[planes]
    assert (idfiles.from_planes([row.tobytes() for row in table], n, planes) == ids).all()


@pytest.mark.parametrize("planes", ["bytes", "bits"])
def test_any_range_is_read_from_its_chunks(tmp_path, planes):
    path = tmp_path / "x.ids"
    rng = np.random.default_rng(1)
    docs = [(i if i % 7 else None, rng.integers(0, 50_000, n, dtype=np.uint32)) for i, n in enumerate([0, 5, 64, 200, 1, 0, 63, 129])]
    writer = idfiles.IdFileWriter(open(path, "wb"), planes, block=64)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    whole = np.concatenate([ids for _, ids in docs])
    file = idfiles.IdFile(str(path))
    assert set(file.chunks[:-1, 1].tolist()) == {64} and file.chunk_ends[-1] == len(whole)
    for first in range(0, len(whole) + 1, 13):
        for stop in (first, first + 1, first + 64, first + 150, len(whole)):
            assert (file.ids(first, stop) == whole[first:stop]).all()
    read = [(d, first, n, np.concatenate([np.empty(0, "<u4"), *parts]).tolist()) for d, first, n, parts in file.documents()]
    begins = np.cumsum([0] + [len(ids) for _, ids in docs])
    assert read == [(d, b, len(ids), ids.tolist()) for (d, ids), b in zip(docs, begins.tolist())]


def test_a_cut_off_file_is_refused(tmp_path):
    path = tmp_path / "x.ids"
    writer = idfiles.IdFileWriter(open(path, "wb"))
    writer.add(1, np.arange(10, dtype="<u4"))
    writer.close()
    path.write_bytes(path.read_bytes()[:-5])
    with pytest.raises(ValueError):
        idfiles.IdFile(str(path))


def test_awkward_rows(awkward, no_docs, tokenizer):
    manifest = idfiles.write_ids(awkward, planes="bits", block=128)
    got = sorted((tuple(r) for r in idfiles.read_ids(manifest, keep_ids=True).collect()), key=lambda r: r[1])
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == sorted(expected(tokenizer, rows), key=repr)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert all(crc32(r[4]) == r[3] and len(r[4]) == 4 * r[2] for r in got)
    assert idfiles.read_ids(idfiles.write_ids(no_docs)).collect() == []


def test_one_doc_id_may_fill_several_files(spark, docs_of):
    same = docs_of([(-(2**63), f"text {i} of one id") for i in range(400)]).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # such little data would be one file
    try:
        manifest = idfiles.write_ids(same)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and manifest.agg(F.sum("n_docs")).first()[0] == 400
    starts = sorted((r["start"], r["n_tokens"]) for r in idfiles.read_ids(manifest).collect())
    assert [s for s, _ in starts] == np.cumsum([0, *(n for _, n in starts)])[:-1].tolist()

import random
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from tallyroll.llm import runs
from tallyroll.llm.queries import QUERIES


def brute(words):
    """(start, length, period) of all runs, period by period."""
    found = {}
    n = len(words)
    for q in range(1, n // runs.TIMES + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(runs.LEAST_LENGTH, runs.TIMES * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def numbered(texts):
    """Word numbers of a batch as the operator gives them, and where texts begin."""
    words, begins = [], [0]
    for text in texts:
        own = {}
        words += [begins[-1] + own.setdefault(w, len(own)) for w in text]
        begins.append(begins[-1] + len(text))
    return np.array(words, np.int64), np.array(begins)


def digest(doc_id, text):
    """A row of the query, from the contract alone."""
    words = (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ")
    words = [w for w in words.split(" ") if w]
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id,
        len(found),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
        n,
    )


def made(rng):
    """A text of few words with periodic stretches of several kinds."""
    out, size = [], rng.choice([1, 2, 3, 20])
    for _ in range(rng.randrange(1, 6)):
        out += [rng.randrange(size) for _ in range(rng.randrange(12))]
        period = [rng.randrange(size) for _ in range(rng.randrange(1, 40))]
        out += (period * rng.randrange(1, 30))[: rng.randrange(1, 200)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_of_many_kinds_of_texts(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [made(rng) for _ in range(rng.randrange(1, 8))] + [[]]
        rng.shuffle(texts)
        words, begins = numbered(texts)
        want = [(int(b) + s, int(b) + s + n, q) for b, t in zip(begins, texts) for s, n, q in brute(t)]
        assert [tuple(r) for r in runs.runs_of(words, begins).tolist()] == want


@pytest.mark.parametrize("text", [[0] * 5000, [0, 1] * 3000 + [0], ([0] * 40 + [1]) * 90, [i % 77 for i in range(4000)]])
def test_texts_that_are_all_runs(text):
    words, begins = numbered([text])
    assert [(s, e - s, q) for s, e, q in runs.runs_of(words, begins).tolist()] == brute(text)


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 2500:
        a, b = b, b + a
    words, begins = numbered([b])
    assert [(s, e - s, q) for s, e, q in runs.runs_of(words, begins).tolist()] == brute(b)


def test_wavelet_tree_against_sorting():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 100):
        values = rng.permutation(n)
        tree = runs.WaveletTree(values, int(n).bit_length())
        for lo in range(n):
            for hi in range(lo + 1, n + 1):
                ordered = np.sort(values[lo:hi])
                many = np.full(hi - lo, 1)
                assert (tree.smallest(lo * many, hi * many, np.arange(hi - lo)) == ordered).all()
                bounds = np.arange(0, n + 2)
                got = tree.below(np.full(len(bounds), lo), np.full(len(bounds), hi), bounds)
                assert (got == np.searchsorted(ordered, bounds)).all()


def test_given_documents_against_plain_search(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text").collect()
    want = sorted(digest(r["doc_id"], r["text"]) for r in rows if len(r["text"] or "") < 6000)
    short = {r[0] for r in want}
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect())
    assert len(got) == len(rows)
    assert [r for r in got if r[0] in short] == want
    assert sum(r[1] > 0 for r in got) > 40


def test_awkward_rows(docs_of, awkward, no_docs):
    planted = [i for i in range(400) if crc32(str(i).encode()) % 10 == 0]
    rows = [(planted[0], "x"), (planted[1], " \n"), (planted[2], None), (planted[3], " a b\tc " * 30), (planted[4], "\x1c" + "w " * 99)]
    rows += [(-(2**63), "p q " * 40), (7, "é é " * 30), (None, "k " * 30)]
    for df in (docs_of(rows), awkward):
        found = runs.find_runs(runs.with_planted_runs(df))
        got = {(r["doc_id"], r["runs_sha256"], r["collapsed_sha256"], r["n_runs"], r["n_words"]) for r in found.collect()}
        want = [digest(r["doc_id"], r["text"]) for r in df.collect()]
        assert got == {(w[0], w[6], w[7], w[1], w[8]) for w in want}
        assert found.count() == df.count()
    assert runs.find_runs(no_docs).collect() == []


def test_a_long_text_keeps_one_period(docs_of):
    words = [f"w{i}" for i in range(700)]
    found = runs.find_runs(docs_of([(1, " ".join(["start", *words * 40, "end"]))])).first()
    assert [tuple(r) for r in found["runs"]] == [(1, 28_000, 700)] and tuple(found["strongest"]) == (1, 28_000, 700)
    assert found["collapsed"] == " ".join(["start", *words, "end"])

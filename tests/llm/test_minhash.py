import random
from itertools import combinations

from tallyroll.llm import minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """(doc_id, n, component) of each row by comparing every two texts."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def answers(df):
    return sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)


def test_given_documents_against_all_pairs(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert answers(documents) == brute(rows)


def test_chains_of_near_copies_against_all_pairs(docs_of):
    """Copies of copies: neighbours are linked, distant ones only through others."""
    rng = random.Random(3)
    rows, words = [], [f"w{rng.random()}" for _ in range(60)]
    for i in range(60):
        rows.append((1000 - i, " ".join(words)))
        words[rng.randrange(60)] = f"n{i}"
    base = [f"b{i}" for i in range(50)]
    for i in range(60):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(50)] = f"x{rng.random()}"
        rows.append((2000 + i, " ".join(own)))
    shared = [f"s{i}" for i in range(30)]
    rows += [(3000 + i, " ".join(shared + [f"t{i}_{k}" for k in range(8 + i % 9)])) for i in range(40)]
    rng.shuffle(rows)
    assert answers(docs_of(rows)) == brute(rows)


def test_awkward_rows(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert answers(awkward) == brute(rows)
    kept = minhash.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 7, 8, 9]


def test_no_rows(no_docs):
    assert answers(no_docs) == []
    assert minhash.keep_one_of_each(no_docs).count() == 0


def test_large_buckets_against_all_pairs(docs_of, monkeypatch):
    """Many copies of a text that is not there, most pairs just below the threshold, some above."""
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(5):
            own[rng.randrange(150)] = f"x{i}_{rng.random()}"
        rows.append((i, " ".join(own)))
        if i % 9 == 0:
            rows.append((500 + i, " ".join([*own[:149], "end"])))
    assert answers(docs_of(rows)) == brute(rows)


def test_one_row_of_each_group_stays(docs_of):
    """Rows are judged by doc_id and text, not by doc_id alone."""
    text = lambda name, n=30: " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, text("a")), (1, text("b")), (2, text("c")), (None, text("c")), (None, text("d")), (None, text("d") + " more")]
    rows += [(3, ""), (3, " "), (3, ""), (4, text("e")), (4, text("e")), (-(2**63), text("f")), (5, text("f")), (None, None), (None, text("g"))]
    got = sorted((tuple(r) for r in minhash.keep_one_of_each(docs_of(rows)).select("doc_id", "text").collect()), key=repr)
    null_ds = [r for r in got if r[0] is None and r[1] and r[1].startswith("d0")]
    assert len(null_ds) == 1
    wanted = [(1, text("a")), (1, text("b")), (2, text("c")), *null_ds, (3, ""), (3, " "), (3, ""), (4, text("e"))]
    wanted += [(-(2**63), text("f")), (None, None), (None, text("g"))]
    assert got == sorted(wanted, key=repr)

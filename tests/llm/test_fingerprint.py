import hashlib

import numpy as np

from tallyroll.llm import fingerprint


def test_entropy_levels_against_plain_counts():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 40, 400).astype(np.uint8)
    data[100:180] = 7
    wanted = []
    for i in range(len(data) - 63):
        share = np.bincount(data[i : i + 64]) / 64
        share = share[share > 0]
        entropy = -(share * np.log2(share)).sum()
        wanted.append(min(int(entropy * 512 / 6 + 1e-9), 511))
    got = fingerprint.entropy_levels(data)
    assert np.abs(got - wanted).max() <= 1
    assert (got == wanted).mean() > 0.98


def plain_places(text, rarity):
    """Selected windows of one text: the leftmost rarest of each neighbourhood, counted."""
    levels = fingerprint.entropy_levels(np.frombuffer(text, np.uint8))
    ranks = rarity[levels]
    if len(text) < 127:
        return set(range(len(levels)))
    times = {}
    for i in range(len(levels) - 63):
        best = i + int(np.argmin(ranks[i : i + 64]))
        times[best] = times.get(best, 0) + 1
    return {p for p, n in times.items() if n >= fingerprint.LEAST_TIMES}


def test_features_do_not_depend_on_their_company():
    rng = np.random.default_rng(4)
    rarity = rng.permutation(fingerprint.LEVELS)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(300)]
    texts = [b" ".join(words[i] for i in rng.integers(0, 300, n)) for n in (200, 0, 5, 60, 12, 1, 400, 20)]
    together = fingerprint.digests(texts, rarity)
    for text, chain in zip(texts, together):
        alone = fingerprint.digests([text], rarity)[0]
        assert np.array_equal(alone, chain)
        if len(text) >= 64:
            distinct = {text[p : p + 64] for p in plain_places(text, rarity)}
            assert len(chain) == -(-len(distinct) // fingerprint.FILTER_FEATURES)


def test_likeness():
    rng = np.random.default_rng(5)
    text = lambda n: b" ".join(bytes(rng.integers(97, 123, 5).astype(np.uint8)) for _ in range(n))
    rarity = np.arange(fingerprint.LEVELS)
    base, other, more = text(400), text(400), text(130)
    a, b, c, none = fingerprint.digests([base, other, base[:1600] + more, b""], rarity)
    assert fingerprint.likeness(a, a) == 1 and fingerprint.likeness(none, none) == 1
    assert fingerprint.likeness(a, none) == 0
    assert fingerprint.likeness(a, b) < 0.1
    assert fingerprint.likeness(a, c) > 0.4
    assert fingerprint.likeness(a, c) == fingerprint.likeness(c, a)


def test_only_empty_texts_have_no_features():
    rng = np.random.default_rng(6)
    rarity = rng.permutation(fingerprint.LEVELS)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in range(1, 251)]
    texts += [b"a" * 127, b"a" * 5000, bytes(range(97, 123)) * 40]  # all windows of one entropy
    chains = fingerprint.digests(texts + [b""], rarity)
    assert [i for i, c in enumerate(chains) if not len(c)] == [len(texts)]
    for n in range(120, 250):
        text, other = texts[n - 1], texts[n]
        edited = fingerprint.digests([text[: n - 20] + other[:20]], rarity)[0]
        assert fingerprint.likeness(chains[n - 1], chains[n]) < 0.2
        if n < 142:  # all windows
            assert fingerprint.likeness(chains[n - 1], edited) > 0.3


def check(df, **options):
    rows = sorted(
        ((r["doc_id"] is None, -(r["doc_id"] or 0), r["text"] or "") for r in df.select("doc_id", "text").collect())
    )
    got = fingerprint.fingerprint_edits(df, **options).collect()
    assert len(got) == len(rows)
    return rows, got


def test_edits_of_given_documents(documents):
    rows, got = check(documents, part_bytes=50_000)
    found = {r["doc_id"]: r for r in got}
    prints = {}
    for (_, back, text), (_, _, after) in zip(rows, rows[1:] + rows[:1]):
        r = found[-back]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == edited:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
    assert np.mean([r["near_edited"] > 0.3 for r in got]) > 0.9
    assert np.mean([r["near_next"] < 0.1 for r in got]) > 0.9
    whole = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(documents).collect()}
    assert whole == {d: r["fingerprint"] for d, r in found.items()}


def test_awkward_rows(awkward, no_docs, docs_of):
    check(awkward)
    check(awkward, part_bytes=200)
    assert check(no_docs)[1] == []
    _, single = check(docs_of([(1, "only one text " * 30)]))
    assert single[0]["near_next"] == 1

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tallyroll.llm import trie
from tallyroll.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hundreds(c):
    """(base, keep) of the query."""
    base = c - (c % 100 if c >= 0 else -(-c % 100))
    return base, crc32(str(c).encode()) % 6


def brute(rows, edit):
    """All nodes from rebuilt conversations, as the contract has it."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c in own:
        base, keep = edit(c)
        rebuilt[c] = own.get(base, [])[:keep] + own[c][keep:]
    members = defaultdict(list)
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        value = (len(cs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += value
    out = []
    for node, cs in members.items():
        ends = sorted(c for c in cs if len(rebuilt[c]) == len(node))
        digest = sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def with_edits(spark, df, edit):
    ids = [r[0] for r in df.select("conv_id").distinct().collect() if r[0] is not None]
    edits = spark.createDataFrame([(c, *edit(c)) for c in ids], "conv_id long, base_id long, keep long")
    return trie.prefix_trie(df, edits)


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = answers(QUERIES["op13_prefix_trie"](spark, sf_dir))
    assert got == brute(rows, by_hundreds)
    assert [r for r in got if r[1] == 0][0][3] == 100


def made(rng, convs):
    """Conversations of few different turns, some long, some with gaps, ties and NULLs."""
    rows = []
    for c in convs:
        for i in range(rng.choice([0, 1, 2, 3, 5, 9, 40])):
            turn = rng.choice([i, i, i, None, 3])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "a b", "", None, "é日"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations(spark, seed):
    rng = random.Random(seed)
    rows = made(rng, [*range(0, 260, 3), 100, -5, -250, -(2**63), 2**63 - 1]) + [(None, 0, "user", "no conversation")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("i", "a", "depth", "_part", "ref", "f0")})
    edits = by_hundreds if seed == 1 else lambda c: (9, c % 7)
    assert answers(with_edits(spark, df, edits)) == brute(rows, edits)


def test_without_edits_and_a_long_conversation(spark):
    rng = random.Random(4)
    long = [(1, i, "user", f"turn {i // 3}") for i in range(150)]
    rows = long + [(2, i, "user", f"turn {i // 3}") for i in range(120)] + made(rng, range(3, 30)) + [(2, 9999, "user", "end")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert answers(trie.prefix_trie(df)) == brute(rows, lambda c: (c, 0))


def test_chains_of_chains(spark):
    """Each conversation branches off the one before, so pointers must be doubled."""
    rows = [(c, i, "user", "same" if i < c else f"own {c}") for c in range(1, 40) for i in range(c + 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert answers(trie.prefix_trie(df)) == brute(rows, lambda c: (c, 0))


def test_meeting_fingerprints_are_seen(spark, monkeypatch):
    """With a tiny hash, different turns or prefixes meet, and the next attempt is taken."""
    rows = [(c, i, "user", f"{c} {i}") for c in range(60) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    seeds, item = [], trie.Monoid.item

    def weak(self, k, *hashes):
        seeds.append(self.seed)
        return item(self, k, *hashes) % 5 if self.seed < 2 else item(self, k, *hashes)

    monkeypatch.setattr(trie.Monoid, "item", weak)
    assert answers(trie.prefix_trie(df)) == brute(rows, lambda c: (c, 0))
    assert set(seeds) == {0, 1, 2}
    monkeypatch.setattr(trie.Monoid, "item", lambda self, k, *hashes: item(self, k, *hashes) % 5)
    with pytest.raises(RuntimeError):
        trie.prefix_trie(df)


def test_different_turns_of_one_hash_are_seen(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, "user", "x"), (2, 0, "user", "y")], SCHEMA)
    hashes = trie._hashes
    monkeypatch.setattr(trie, "_hashes", lambda seed: hashes(seed) if seed else [F.lit(1).cast("long").alias(n) for n in "ab"])
    assert answers(trie.prefix_trie(df)) == brute([tuple(r) for r in df.collect()], lambda c: (c, 0))


def test_empty_tables_and_turnless_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(7, None, None, None), (8, 1, "user", "x"), (8, 1, "user", "x")], SCHEMA)
    edits = lambda c: (99, 5)
    assert answers(with_edits(spark, df, edits)) == brute([tuple(r) for r in df.collect()], edits)

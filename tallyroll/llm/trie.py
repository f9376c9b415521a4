"""The trie of conversation prefixes, with rebuilt conversations fingerprinted from their parts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyroll.llm.common import maybe_among, running_totals, ship, written

# Fingerprints are sums of hash * base**place modulo these primes below 2**31, so that products fit a long.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
ATTEMPTS = 8
_DIGITS, _RADIX = 8, 16  # exponents below 16**8

_KEY = ["depth", *(f"f{k}" for k in range(len(PRIMES)))]
_PARENT = ["parent_depth", *(f"q{k}" for k in range(len(PRIMES)))]


# --- the monoid -------------------------------------------------------------
class Monoid:
    """Fingerprints (length, value) of sequences, one value per prime, that compose without the sequences.

    A sequence t1 ... tn has the value sum of ti * base**i; (m, u) followed by (n, v) is (m + n, u + v * base**m). As base
    has an inverse, a suffix is taken out of two prefixes the same way.
    """

    def __init__(self, seed: int):
        self.seed = seed
        self.bases = [2 + xxh3_64_intdigest(f"{seed} {k}") % (p - 3) for k, p in enumerate(PRIMES)]

    def item(self, k: int, *hashes: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(k), *hashes), F.lit(PRIMES[k]))

    def power(self, k: int, exponent: str, inverse: bool = False) -> str:
        """SQL of base**exponent, or of its inverse, from tables of the powers of each hexadecimal digit."""
        p = PRIMES[k]
        base = pow(self.bases[k], -1, p) if inverse else self.bases[k]
        result = "1L"
        for d in range(_DIGITS):
            table = ", ".join(f"{pow(base, v * _RADIX**d, p)}L" for v in range(_RADIX))
            result = f"{result} * get(array({table}), cast(shiftright({exponent}, {4 * d}) & {_RADIX - 1} as int)) % {p}L"
        return f"({result})"


# --- turns ------------------------------------------------------------------
def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Every turn in order: conv_id, its place ``i`` from 1, hashes a and b of role and text, and its size.

    ``ref`` orders all turns and names one; rows are narrow from here on.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).where("conv_id is not null")
    order = ["conv_id", "turn", "role", "text"]
    narrow = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.monotonically_increasing_id().alias("ref"),
        *_hashes(seed),
        F.length("text").cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
    )
    return running_totals(narrow, ["conv_id"], ["ref"], "one", "i").drop("one")


def _hashes(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), F.lit(n), "role", "text").alias(n) for n in ("a", "b")]


def _same_hash_other_turn(conversations: DataFrame, turns: DataFrame, seed: int) -> bool:
    """Whether two different turns have the same hashes: only turns whose hashes repeat are read again."""
    repeated = written(turns.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    texts = conversations.where("conv_id is not null").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    texts = maybe_among(texts.select("role", "text", *_hashes(seed)), F.col("a"), repeated, F.col("a"))
    # Equal turns are combined before they are shuffled.
    different = texts.groupBy("a", "b", "role", "text").agg(F.lit(1).alias("_one"))
    return not different.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


# --- prefixes ---------------------------------------------------------------
def _prefixes(turns: DataFrame, edits: DataFrame, monoid: Monoid) -> tuple[DataFrame, DataFrame]:
    """One row per conversation and non-empty prefix of its rebuilt form, with the fingerprints of it and of its parent.

    A prefix that ends in own turns is composed from the fingerprint of the base's head and
    that of the own turns, which is the difference of two prefixes of the original. Also returns the
    conversations that have no turn once rebuilt.
    """
    ks = range(len(PRIMES))
    items = [monoid.item(k, F.col("a"), F.col("b")).alias(f"t{k}") for k in ks]
    valued = turns.select("*", *items)
    terms = [F.expr(f"t{k} * {monoid.power(k, 'i')} % {PRIMES[k]}L").alias(f"s{k}") for k in ks]
    valued = valued.select("conv_id", "ref", "i", "a", "b", "size", *[f"t{k}" for k in ks], *terms)
    sums = [f"v{k}" for k in ks]
    valued = running_totals(valued, ["conv_id"], ["ref"], [f"s{k}" for k in ks], sums)
    valued = written(valued.withColumns({v: F.col(v) % p for v, p in zip(sums, PRIMES)}))

    most = edits.agg(F.max("keep")).first()[0] or 0
    heads = written(valued.where(F.col("i") <= most).select("conv_id", "i", "a", "b", "size", *sums, *[f"t{k}" for k in ks]))
    counts = written(valued.groupBy("conv_id").agg(F.max("i").alias("n")))
    of_base = counts.select(F.col("conv_id").alias("base_id"), F.col("n").alias("n_base"))
    convs = edits.join(counts, "conv_id", "left").join(of_base, "base_id", "left").select(
        "conv_id",
        "base_id",
        "keep",
        F.coalesce("n", F.lit(0)).alias("n_own"),
        F.least("keep", F.coalesce("n_base", F.lit(0))).alias("n_head"),
    )
    head_end = heads.select(F.col("conv_id").alias("base_id"), F.col("i").alias("n_head"), *[F.col(v).alias(f"head_{v}") for v in sums])
    own_end = heads.select("conv_id", F.col("i").alias("keep"), *[F.col(v).alias(f"own_{v}") for v in sums])
    convs = convs.join(head_end, ["base_id", "n_head"], "left").join(own_end, ["conv_id", "keep"], "left")
    convs = written(convs.na.fill(0, [f"{part}_{v}" for part in ("head", "own") for v in sums]))

    # Heads: the base's own prefixes as they are.
    first = convs.select(F.col("conv_id").alias("conv"), F.col("base_id").alias("conv_id"), "keep", "n_own", "n_head")
    first = first.where("n_head > 0").join(heads, "conv_id").where("i <= n_head")
    columns = [*[f"t{k}" for k in ks], "a", "b", "size"]
    as_key = [f"{v} AS {f}" for v, f in zip(sums, _KEY[1:])]
    first = first.selectExpr("conv AS conv_id", "i AS depth", *columns, *as_key, "i = n_head AND n_own <= keep AS last")
    # Own turns behind the head: composed.
    own = valued.join(convs.where("n_own > keep"), "conv_id").where("i > keep")
    composed = [
        f"pmod(head_v{k} + pmod(v{k} - own_v{k}, {p}L) * {monoid.power(k, '(keep - n_head)', True)}, {p}L) AS f{k}"
        for k, p in enumerate(PRIMES)
    ]
    own = own.selectExpr("conv_id", "i - keep + n_head AS depth", *columns, *composed, "i = n_own AS last")
    # Without its last turn, a prefix is its parent.
    parents = [f"pmod(f{k} - t{k} * {monoid.power(k, 'depth')}, {p}L) AS q{k}" for k, p in enumerate(PRIMES)]
    rows = first.union(own).selectExpr("conv_id", *_KEY, "depth - 1 AS parent_depth", *parents, "last", "a", "b", "size")
    turnless = convs.where("n_head = 0 and n_own <= keep").select("conv_id")
    return written(rows), turnless


# --- nodes ------------------------------------------------------------------
def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with n_leaves and saved_tokens summed over every subtree.

    The nodes whose smallest member is c are one downward chain: so the trie is a
    tree of chains, one per conversation at most. Sums over whole subtrees of that tree come by pointer
    doubling, in as many rounds as the logarithm of its height; each chain's total is then
    added where the chain hangs, and running totals from below finish the chain above it.
    """
    values = ["leaf", "saved"]
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.min(F.struct("depth", "parent_conv_id"))["parent_conv_id"].alias("above"), *[F.sum(v).alias(v) for v in values]
    )
    chains = written(chains)
    state = chains.select("conv_id", F.col("above").alias("to"), *values)
    while not state.where("to is not null").isEmpty():
        given = state.where("to is not null").groupBy(F.col("to").alias("conv_id")).agg(*[F.sum(v).alias(f"{v}_below") for v in values])
        further = state.select(F.col("conv_id").alias("to"), F.col("to").alias("next"))
        state = state.join(written(given), "conv_id", "left").join(further, "to", "left")
        state = written(
            state.select("conv_id", F.col("next").alias("to"), *[(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in values])
        )
    hung = chains.where("above is not null").select("conv_id", "above", (F.col("top") - 1).alias("depth")).join(state, "conv_id")
    hung = hung.groupBy(F.col("above").alias("conv_id"), "depth").agg(*[F.sum(v).alias(f"{v}_hung") for v in values])
    summed = nodes.join(written(hung), ["conv_id", "depth"], "left")
    summed = summed.withColumns({v: F.col(v) + F.coalesce(f"{v}_hung", F.lit(0)) for v in values})
    summed = summed.drop(*[f"{v}_hung" for v in values]).withColumn("_up", -F.col("depth"))
    return running_totals(summed, ["conv_id"], ["_up"], values, ["n_leaves", "saved_tokens"]).drop("_up")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums of the ids of each key; rows come ordered, so that of a group only the running state is held."""
    now, check = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.array(list(map(str, batch.column("conv_id").to_pylist())), object)
        keys = np.stack([batch.column(c).to_numpy() for c in _KEY], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
        done = []
        for a, b in zip(cuts, cuts[1:]):
            key, part = tuple(keys[a].tolist()), ",".join(ids[a:b]).encode()
            if key == now:
                check.update(b"," + part)
                continue
            if now is not None:
                done.append((*now, check.hexdigest()))
            now, check = key, sha256(part)
        if done:
            yield _digests(done)
    if now is not None:
        yield _digests([(*now, check.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * len(_KEY) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*_KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """The trie of all conversations (conv_id, turn, role, text), rebuilt by ``edits``, one row per node.

    A row of ``edits`` (conv_id, base_id, keep; one per conversation) replaces the first ``keep`` turns of a
    conversation by those of ``base_id`` (fewer if that has fewer, none if it doesn't exist). Without
    it conversations stay as they are. Rebuilt conversations are never written out: the fingerprint of each
    prefix is composed from those of its two parts, and prefixes meet by it.

    Returns conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (characters that reuse of the prefix spares, over the subtree) and ends_sha256. Every group is
    verified: its members agree in their last turn, looked up by reference and compared as text, and in
    their parent; so, from the root on, they are equal. If any group fails, all is
    done again with other hashes.

    Turns are ordered by turn (NULL first), then role and text; NULL role or text is empty. Repeated rows are repeated turns.
    Rows with a NULL conv_id belong to no conversation and are left out. An empty table has no
    node, not even a root. The ids that end in one node stream through one task, since a
    SHA-256 can't be taken in parts; they are never held.
    """
    ship(conversations.sparkSession)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    if edits is None:
        edits = ids.select("conv_id", F.col("conv_id").alias("base_id"), F.lit(0).cast("long").alias("keep"))
    edits = written(edits.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "base_id", "keep")]))
    for seed in range(ATTEMPTS):
        turns = written(_turns(conversations, seed))
        if _same_hash_other_turn(conversations, turns, seed):
            continue
        prefixes, turnless = _prefixes(turns, edits, Monoid(seed))
        same = ["a", "b", *_PARENT[1:]]
        nodes = prefixes.groupBy(*_KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("size").alias("size"),
            *[F.min(c).alias(c) for c in same],
            *[F.max(c).alias(f"{c}_most") for c in same],
        )
        nodes = written(nodes)
        differs = F.lit(False)
        for c in same:
            differs = differs | (F.col(c) != F.col(f"{c}_most"))
        if nodes.where(differs).isEmpty():
            break
    else:
        raise RuntimeError(f"fingerprints of different prefixes met in each of {ATTEMPTS} attempts")
    nodes = nodes.select(*_KEY, "conv_id", "n_convs", "size", (F.col("depth") - 1).alias("parent_depth"), *_PARENT[1:])
    nothing = [F.lit(0).cast("long").alias(c) for c in _KEY]
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(*nothing, "conv_id", "n_convs", F.lit(0).cast("long").alias("size"))
    everything = nodes.drop(*_PARENT).union(root)

    at_parent = [F.col(q).alias(f) for q, f in zip(_PARENT, _KEY)]
    children = nodes.groupBy(*at_parent).agg(F.count(F.lit(1)).alias("n_children"))
    parents = everything.select(*[F.col(f).alias(q) for q, f in zip(_PARENT, _KEY)], F.col("conv_id").alias("parent_conv_id"))
    above = nodes.join(parents, _PARENT).select(*_KEY, "parent_conv_id")
    full = everything.join(children, _KEY, "left").join(above, _KEY, "left").select(
        *_KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "size"
    )
    full = full.withColumns(
        {"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("size")}
    )
    summed = _subtree_sums(written(full))

    ends = prefixes.where("last").select(*_KEY, "conv_id").union(turnless.select(*nothing, "conv_id"))
    ordered = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")
    digests = ordered.mapInArrow(_digest_batches, ", ".join(f"{c} long" for c in _KEY) + ", ends_sha256 string")
    return summed.join(digests, _KEY, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )

"""Near-duplicate documents: many universal hash minima, banding, verification and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyroll.llm.common import maybe_among, mix64, packed, row_slices, scratch, ship, text_or_empty, written
from tallyroll.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 75  # percent
# At a similarity of 0.75 a pair shares none of 36 bands of 5 with probability 6e-5, at 0.8 with 6e-7.
BANDS, ROWS = 36, 5
# Estimates from 180 minima spread by 0.032 at 0.75: this floor lies almost five of those below.
LEAST_ESTIMATE = 0.60
# Nodes of buckets with more than SMALL members are compared blockwise. There sets are held as 32-bit hashes, whose
# chance meetings can shift a count a little: pairs within SLACK of the threshold go on to the full sets as well.
SMALL, BLOCK, SLACK = 16, 512, 2

_BATCH_BYTES = 4 << 20
_KNOWN_WORDS = 300_000

_SKETCH = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, minima binary"
_SETS = "node long, shingles binary"


class _WordHashes(dict):
    """64-bit hashes of words as bytes, remembered while there are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def _shingle_sets(texts: pa.Array, hashes: _WordHashes) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; texts are UTF-8 and may be NULL.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at exactly the six
    ASCII blanks, which is what the contract of words asks for.
    """
    powers = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
    out = []
    for value in texts:
        if not value.is_valid:
            out.append(np.empty(0, np.uint64))
            continue
        words = value.as_buffer().to_pybytes().lower().split()
        n = len(words)
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
        if n == 0:
            out.append(h)
            continue
        width = min(n, SHINGLE)
        total = h[: n - width + 1] * powers[0]
        for k in range(1, width):
            total = total + h[k : n - width + 1 + k] * powers[k]
        # A short text is one sequence: its length keeps it apart from shingles.
        out.append(np.unique(mix64(total + np.uint64(width))))
    return out


def _identity(shingles: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that name the set, whatever its order."""
    a = np.add.reduce(shingles, dtype=np.uint64)
    b = np.add.reduce(mix64(shingles ^ np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)
    return a.astype(np.int64), b.astype(np.int64)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal hashes (a * x + b mod 2**64, a odd), one row per non-empty set."""
    count = BANDS * ROWS
    a = mix64(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)
    b = mix64(np.arange(10_001, count + 10_001, dtype=np.uint64))
    out = np.empty((count, len(sets)), np.uint64)
    block = 16_384  # values that stay in the processor's cache over all hashes
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (stop == start or held + len(sets[stop]) <= block):
            held += len(sets[stop])
            stop += 1
        values = np.concatenate(sets[start:stop])
        begins = np.cumsum([0] + [len(s) for s in sets[start : stop - 1]])
        hashed = np.empty_like(values)
        for k in range(count):
            np.multiply(values, a[k], out=hashed)
            np.add(hashed, b[k], out=hashed)
            out[k, start:stop] = np.minimum.reduceat(hashed, begins)
        start = stop
    return out.T


def _band_keys(minima: np.ndarray) -> np.ndarray:
    grouped = minima.reshape(len(minima), BANDS, ROWS)
    key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(minima), BANDS)).copy()
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key.astype(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for whole in batches:
        for batch in row_slices(whole, 1, _BATCH_BYTES):
            sets = _shingle_sets(batch.column(1), hashes)
            filled = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            minima: list = [None] * len(sets)
            if filled:
                found = _minima([sets[i] for i in filled])
                short = (found >> np.uint64(56)).astype(np.uint8)
                for i, keys, row in zip(filled, _band_keys(found), short):
                    bands[i], minima[i] = keys, row.tobytes()
            names = [_identity(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([n[0] for n in names], pa.int64()),
                    pa.array([n[1] for n in names], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(minima, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "minima"],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of nodes; a row whose set is another one than its node's is passed over."""
    hashes = _WordHashes()
    for whole in batches:
        for batch in row_slices(whole, 3, _BATCH_BYTES):
            node, set_a, set_b = (batch.column(i).to_pylist() for i in range(3))
            sets = _shingle_sets(batch.column(3), hashes)
            right = [i for i, s in enumerate(sets) if tuple(map(int, _identity(s))) == (set_a[i], set_b[i])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[i] for i in right], pa.int64()), pa.array([sets[i].tobytes() for i in right], pa.binary())],
                names=["node", "shingles"],
            )


def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough and whose sizes allow the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
        agree = (left == right).mean(axis=1) >= LEAST_ESTIMATE
        kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
        yield kept.filter(pa.array(agree))


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= SIMILARITY * (len(x) + len(y) - common))
        kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
        yield kept.filter(pa.array(keep, pa.bool_()))


def _short_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(np.frombuffer(v.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "short"])


def _block_pairs(group: pa.Table) -> pa.Table:
    """Pairs of two blocks of one family (or inside one block), of different components, that are links or almost."""
    first, second = (group.column(c)[0].as_py() for c in ("first", "second"))
    block, node, component = (group.column(c).to_numpy() for c in ("block", "node", "component"))
    minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint8).reshape(len(node), -1)
    sets = [np.frombuffer(v.as_buffer(), np.uint32) for v in group.column("short")]
    sizes = np.array([len(s) for s in sets])
    a, b = [], []
    for i in np.flatnonzero(block == first):
        # Inside one block every pair would come twice.
        likely = (block == second) & (component != component[i]) & ((first != second) | (node > node[i]))
        likely &= 100 * np.minimum(sizes, sizes[i]) + 100 * SLACK >= SIMILARITY * np.maximum(sizes, sizes[i])
        likely = np.flatnonzero(likely)
        likely = likely[(minima[likely] == minima[i]).mean(axis=1) >= LEAST_ESTIMATE]
        for j in likely:
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True)) + SLACK
            if 100 * common >= SIMILARITY * (sizes[i] + sizes[j] - common):
                a.append(min(node[i], node[j]))
                b.append(max(node[i], node[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


class _Links:
    """Verified links between the nodes (distinct shingle sets) of one run."""

    def __init__(self, nodes: DataFrame, sets: DataFrame):
        self.nodes, self.sets = nodes, sets
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None
        self._parts: DataFrame | None = None

    def _sides(self, pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
        left = table.select(F.col("node").alias("a"), F.col(value).alias("_left"))
        right = table.select(F.col("node").alias("b"), F.col(value).alias("_right"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right")

    def verify(self, pairs: DataFrame) -> None:
        """Adds the links among ``pairs`` (a < b) that were not tried before."""
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = written(pairs)
        likely = written(self._sides(pairs, self.nodes, "minima").mapInArrow(_estimate_batches, "a long, b long"))
        found = written(self._sides(likely, self.sets, "shingles").mapInArrow(_verify_batches, "a long, b long"))
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        if self.links is None or not found.isEmpty():
            self.links = found if self.links is None else self.links.union(found)
            self._parts = None

    def components(self) -> DataFrame:
        """(node, component) of all nodes with a link; found anew only after new links."""
        if self._parts is None:
            self._parts = connected_components(self.links)
        return self._parts

    def open_members(self, members: DataFrame) -> DataFrame:
        """Members of buckets that hold more than one component, with their component."""
        members = members.select("key", "node", "popularity").join(self.components(), "node", "left")
        members = written(members.withColumn("component", F.coalesce("component", "node")))
        spread = members.groupBy("key").agg(
            (F.min("component") < F.max("component")).alias("open"), F.count(F.lit(1)).alias("members")
        )
        return written(members.join(written(spread.where("open").drop("open")), "key"))

    def pairs_across(self, members: DataFrame) -> DataFrame:
        """Pairs (a < b) of open buckets, of different components, that may be links.

        A small bucket gives all its pairs, at most SMALL / 2 for a member. Nodes of large buckets
        that hang together are one family, whatever number of buckets they share: a
        family is cut into blocks, and two blocks at a time are compared inside a task,
        by signatures and then by sets, which gives out only links and near misses.
        """
        few = members.where(F.col("members") <= SMALL)
        other = few.select("key", F.col("node").alias("other"), F.col("component").alias("other_component"))
        small = few.join(other, "key").where("node < other and component <> other_component")
        many = members.where(F.col("members") > SMALL).select("key", "node", "component")
        least = written(many.groupBy("key").agg(F.min("node").alias("b")))
        hung = many.join(least, "key").select(F.col("node").alias("a"), "b").distinct()
        families = written(connected_components(hung).withColumnRenamed("component", "family"))
        sizes = families.groupBy("family").agg(F.expr(f"(count(1) + {BLOCK - 1}) div {BLOCK}").alias("blocks"))
        placed = families.join(written(sizes), "family").join(many.select("node", "component").distinct(), "node")
        held = self.sets.join(families.select("node"), "node").mapInArrow(_short_batches, "node long, short binary")
        held = written(held.join(self.nodes.select("node", "minima"), "node"))
        cut = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(held, "node")
        cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cut = cut.select(
            "family",
            F.least("block", "with").alias("first"),
            F.greatest("block", "with").alias("second"),
            *["block", "node", "component", "minima", "short"],
        )
        large = cut.groupBy("family", "first", "second").applyInArrow(_block_pairs, "a long, b long")
        return small.select(F.col("node").alias("a"), F.col("other").alias("b")).union(large).distinct()


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of ``wanted`` (node, least_doc, set_a, set_b): only their texts are read again."""
    texts = maybe_among(docs, F.col("doc_id"), wanted, F.col("least_doc"))
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("least_doc")))
    texts = texts.select("node", "set_a", "set_b", F.col("text").cast("binary").alias("text"))
    return written(texts.mapInArrow(_set_batches, _SETS).dropDuplicates(["node"]))


def _components_of(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """(set_a, set_b, component_id, component) of every set of shingles that is not empty."""
    filled = sketch.where("n_shingles > 0")
    nodes = written(
        filled.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("least_doc"),
            F.any_value("bands").alias("bands"),
            F.any_value("minima").alias("minima"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    exploded = nodes.select("node", F.explode("bands").alias("key"))
    shared = written(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = written(exploded.join(shared, "key"))
    popular = written(members.groupBy("node").agg(F.sum("n").alias("popularity")))
    members = written(members.drop("n").join(popular, "node"))
    sets = _sets_of(docs, written(popular.select("node").join(nodes.select("node", "least_doc", "set_a", "set_b"), "node")))
    links = _Links(nodes, sets)

    rank = F.struct("popularity", (-F.col("node")).alias("_least"))
    hubs = written(members.groupBy("key").agg(F.max_by("node", rank).alias("hub")))
    links.verify(members.join(hubs, "key").where("node <> hub").select(*_ordered("hub", "node")).distinct())

    members = links.open_members(members)
    links.verify(links.pairs_across(members))

    named = nodes.select("node", "set_a", "set_b", "least_doc").join(links.components(), "node", "left")
    named = written(named.withColumn("component", F.coalesce("component", "node")).drop("node"))
    least = written(named.groupBy("component").agg(F.min("least_doc").alias("component_id")))
    return named.join(least, "component").select("set_a", "set_b", "component_id", "component")


def _judged(docs: DataFrame) -> DataFrame:
    """What ``near_duplicates`` returns, with a hash of each row's text and a number for its group (NULL: alone)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64(text_or_empty()).alias("text_hash"))
    with scratch() as keep:
        sketch = keep(written(narrow.mapInArrow(_sketch_batches, _SKETCH)))
        named = keep(written(_components_of(docs, sketch)))
    filled = sketch.where("n_shingles > 0")
    grouped = filled.select("doc_id", "n_shingles", "text_hash", "set_a", "set_b").join(named, ["set_a", "set_b"])
    alone = sketch.where("n_shingles = 0")
    alone = alone.withColumns({"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")})
    columns = ["doc_id", "n_shingles", "component_id", "component", "text_hash"]
    return (
        grouped.select(*columns)
        .union(alone.select(*columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Documents linked when 100 * intersection >= 75 * union of their 5-word shingle sets.

    Returns doc_id, n_shingles, component_id (the least doc_id of the group) and
    kept, one row per row of ``docs`` (doc_id, text; others are ignored).

    Equal sets are one node, so copies cost nothing. Candidates share a band of
    minima. Linking every pair of a bucket would grow with its square, so each
    bucket is first compared with one hub: its most popular member, which shares
    its bands with most others, as the origin of a family of edited copies does.
    Then only pairs of a bucket that are still in different components are compared
    with each other, blockwise where buckets are large, once for all buckets that hang together: that
    finds every link that could join two components.

    NULL and blank texts have an empty set and stay alone. Rows with a NULL
    doc_id take part; a group without any doc_id has component_id NULL, and its
    rows are kept. Repeated doc_ids are judged row by row.
    """
    return _judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the near copies: of every group the row with the least doc_id (NULL last) stays.

    Rows are told apart by doc_id and text: rows that share a doc_id but are in different groups are
    judged apart, so one doc_id may stay with two texts. Between rows of one group and doc_id the
    least hash of the text decides, and of rows equal in both one stays. Rows without words are in no group and all stay.
    Very long texts are read whole; an empty table stays empty; other columns stay as they were.
    """
    judged = written(_judged(docs).select("doc_id", "text_hash", "n_shingles", "component"))
    listed = judged.where("n_shingles > 0").groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n")
    kept = listed.groupBy("component").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.text_hash", "kept.n")
    wordless = judged.where("n_shingles = 0").select("doc_id", "text_hash", F.lit(1).cast("long").alias("n")).distinct()
    verdicts = written(kept.union(wordless)).select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"), "n")
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), text_hash=F.xxhash64(text_or_empty()))
    rows = rows.join(verdicts, F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("text_hash") == F.col("_kept_hash")))
    once = rows.where("n = 1").select("_row.*")
    # Equal rows; the window cuts each group map-side.
    any_order = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("_row"))
    again = rows.where("n > 1").withColumn("_rank", F.row_number().over(any_order)).where("_rank = 1")
    return once.unionByName(again.select("_row.*"))

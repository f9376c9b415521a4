"""Improbable-feature digests: rare byte windows in chained Bloom filters, compared by their bits."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import mix64, row_slices, ship, text_or_empty, written

WINDOW = 64  # bytes of a feature
NEIGHBOURS = 64  # a feature must be the rarest of this many neighbouring windows ...
LEAST_TIMES = 16  # ... in at least this many ways to choose them
FILTER_BYTES, PROBES = 256, 5
FILTER_FEATURES = 128  # a fuller filter is closed and the next one opened
LEVELS = 512  # of entropy
PART_BYTES = 16 << 20  # of text in a sorted part
MOST_PARTS = 2048
_BATCH_BYTES = 1 << 20
_BITS = FILTER_BYTES * 8
# n log2 n, in whole steps, so that running sums stay exact.
_STEP = 1 << 20
_NLOGN = np.array([0] + [round(n * np.log2(n) * _STEP) for n in range(1, WINDOW + 1)], np.int64)
_GAIN = np.diff(_NLOGN)  # from n to n + 1


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """The entropy of every window of ``data``, as a level from 0 to LEVELS - 1.

    A window differs from the one before by one byte that left and one that
    came. How much that changes the sum of n log n depends on how often these
    bytes occur in the 63 bytes that both share, which shifted comparisons count.
    """
    size = len(data) - WINDOW + 1
    if size <= 0:
        return np.empty(0, np.int64)
    before = np.zeros(len(data), np.uint8)  # equal bytes among the 63 before
    after = np.zeros(len(data), np.uint8)
    for shift in range(1, WINDOW):
        equal = (data[shift:] == data[:-shift]).view(np.uint8)
        before[shift:] += equal
        after[:-shift] += equal
    first = np.bincount(data[:WINDOW], minlength=256)
    change = _GAIN[before[WINDOW:]] - _GAIN[after[: size - 1]]
    total = np.concatenate([[_NLOGN[first].sum()], change]).cumsum()
    entropy = np.log2(WINDOW) - total / (_STEP * WINDOW)
    return np.minimum((entropy * (LEVELS / np.log2(WINDOW))).astype(np.int64), LEVELS - 1).clip(0)


def _inside(lengths: np.ndarray, span: int) -> np.ndarray:
    """Which places of the joined texts begin a stretch of ``span`` bytes that stays in its text."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    places = np.arange(len(ends))
    return (places + span <= ends)[: max(0, len(ends) - span + 1)]


def features(joined: np.ndarray, lengths: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of the selected features of joined texts, in order, repeats in a text removed."""
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    levels = entropy_levels(joined)
    if not len(levels):
        return none
    valid = _inside(lengths, WINDOW)
    # The rarest window of a neighbourhood; the leftmost of equals. Small keys are rare.
    key = np.where(valid, rarity[levels], LEVELS).astype(np.int64) << 32 | np.arange(len(levels))
    widest = NEIGHBOURS
    least = key
    width = 1
    while width < widest:
        least = np.minimum(least[: len(least) - width], least[width:]) if len(least) > width else np.empty(0, np.int64)
        width *= 2
    whole = _inside(lengths, WINDOW + NEIGHBOURS - 1)
    chosen = least[: len(whole)][whole[: len(least)]] & 0xFFFFFFFF
    picked = np.flatnonzero(np.bincount(chosen, minlength=1) >= LEAST_TIMES)
    # Texts without such a window, as are all that are too short for a neighbourhood, have all their windows.
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bare = np.bincount(owner[picked], minlength=len(lengths)) == 0
    places = np.union1d(picked, np.flatnonzero(valid & bare[owner[: len(valid)]]))
    if not len(places):
        return none
    powers = mix64(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
    hashed = np.zeros(len(places), np.uint64)
    for k in range(WINDOW):
        hashed += (joined[places + k].astype(np.uint64) + np.uint64(1)) * powers[k]
    hashed = mix64(hashed)
    texts = owner[places]
    order = np.lexsort((places, hashed, texts))
    again = np.zeros(len(places), bool)
    again[1:] = (texts[order][1:] == texts[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
    keep = np.sort(order[~again])
    return texts[keep], hashed[keep]


def digests(texts: list[bytes], rarity: np.ndarray) -> list[np.ndarray]:
    """The chain of Bloom filters of each text, one row of bytes per filter; no rows for an empty text.

    Texts shorter than a window are one feature, unless they are empty.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    owner, hashed = features(joined, lengths, rarity)
    tiny = [i for i, t in enumerate(texts) if 0 < len(t) < WINDOW]
    if tiny:
        own = [int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little") for i in tiny]
        owner, hashed = np.concatenate([owner, tiny]), np.concatenate([hashed, np.array(own, np.uint64)])
    order = np.argsort(owner, kind="stable")
    owner, hashed = owner[order], hashed[order]
    counts = np.bincount(owner, minlength=len(texts)) if len(texts) else np.empty(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(counts)])
    number = np.arange(len(owner)) - begins[owner]
    chain = -(-counts // FILTER_FEATURES)
    rows = np.concatenate([[0], np.cumsum(chain)])
    bits = np.zeros((int(rows[-1]), _BITS), bool)
    row = rows[owner] + number // FILTER_FEATURES
    for k in range(PROBES):
        bits[row, (hashed >> np.uint64(11 * k)).astype(np.int64) % _BITS] = True
    packed = np.packbits(bits, axis=1)
    return [packed[rows[i] : rows[i + 1]] for i in range(len(texts))]


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1: how many bits two chains share beyond what chance gives.

    Every filter of the shorter chain is held against the most similar one of
    the longer chain; the mean is weighted by set bits. Two empty chains, of
    empty texts, are alike.
    """
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    if x.shape == y.shape and np.array_equal(x, y):
        return 1.0
    if (len(x), x.tobytes()) > (len(y), y.tobytes()):
        x, y = y, x
    a, b = (np.unpackbits(v, axis=1).astype(np.float32) for v in (x, y))
    common = a @ b.T
    na, nb = a.sum(axis=1)[:, None], b.sum(axis=1)[None, :]
    chance, most = na * nb / _BITS, np.minimum(na, nb)
    share = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    # A filter with far fewer bits than the other fits inside by chance: sizes count as well.
    share = share * np.minimum(na, nb) / np.maximum(na, nb)
    weights = na[:, 0]
    return float((share.max(axis=1) * weights).sum() / weights.sum())


def as_text(chain: np.ndarray) -> str:
    return chain.tobytes().hex()


# --- corpus -----------------------------------------------------------------
def _histogram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS, np.int64)
    for whole in batches:
        for batch in row_slices(whole, 0, _BATCH_BYTES):
            texts = [v.as_buffer().to_pybytes() for v in batch.column(0)]
            levels = entropy_levels(np.frombuffer(b"".join(texts), np.uint8))
            total += np.bincount(levels[_inside(np.array([len(t) for t in texts], np.int64), WINDOW)], minlength=LEVELS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(total)], names=["level", "n"])


def corpus_rarity(docs: DataFrame) -> np.ndarray:
    """The rank of every entropy level, rarest first, over all windows of all texts.

    Levels that never occur come first, since any text that shows one is remarkable.
    """
    ship(docs.sparkSession)
    data = docs.select(text_or_empty().cast("binary").alias("data"))
    counts = data.mapInArrow(_histogram_batches, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    n = np.zeros(LEVELS, np.int64)
    for r in counts.collect():  # LEVELS rows
        n[r["level"]] = r["n"]
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), n))] = np.arange(LEVELS)
    return rank


def fingerprints(docs: DataFrame, rarity: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``: its Bloom filters as lower-case hex, '' for an empty text.

    NULL counts as empty. Equal texts have equal fingerprints for one ``rarity``,
    which by default is taken from all of ``docs``.
    """
    ship(docs.sparkSession)
    rank = corpus_rarity(docs) if rarity is None else rarity

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, 1, _BATCH_BYTES):
                texts = [v.as_buffer().to_pybytes() for v in batch.column(1)]
                made = [as_text(d) for d in digests(texts, rank)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("data"))
    return narrow.mapInArrow(work, "doc_id long, fingerprint string")


# --- documents, their neighbours and edits ------------------------------------
_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare_batches(batches: Iterator[pa.RecordBatch], rarity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Compares every own row with the row after it; a guest row only serves as the last one's next."""
    held: list[tuple] = []  # (doc_id, text) of own rows, and the row that follows them

    def out(rows: list[tuple]) -> pa.RecordBatch:
        """Results for all of ``rows`` but the last."""
        texts = [r[1] for r in rows]
        edited = []
        for text, after in zip(texts, texts[1:]):
            cut = len(text) // 3
            edited.append(text[: len(text) - cut] + after[:cut])
        coded, coded_edits = [t.encode() for t in texts], [t.encode() for t in edited]
        own, changed = digests(coded, rarity), digests(coded_edits, rarity)
        columns = [
            ([r[0] for r in rows[:-1]], pa.int64()),
            ([len(t) for t in texts[:-1]], pa.int64()),
            ([hashlib.sha256(t).hexdigest() for t in coded_edits], pa.string()),
            ([as_text(d) for d in own[:-1]], pa.string()),
            ([as_text(d) for d in changed], pa.string()),
            ([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
            ([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        ]
        names = [c.split()[0] for c in _EDITED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names=names)

    size = 0
    for whole in batches:
        for batch in row_slices(whole, 1, _BATCH_BYTES):
            for doc_id, text, guest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.append((doc_id, text))
                size += len(text)
                if guest or size >= _BATCH_BYTES:
                    if len(held) > 1:
                        yield out(held)
                    held = [] if guest else held[-1:]
                    size = 0 if guest else len(text)


def fingerprint_edits(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they are.

    The edit replaces the last third of a text (in code points, rounded down) by
    as many first code points of the next document, in descending doc_id (NULL
    last, ties by text hash), after the last the first. NULL is empty. A single
    document is its own next one.

    Documents are laid out in sorted parts of about ``part_bytes``, MOST_PARTS at most, in one shuffle
    of their texts; a part is read as a stream, so its size is free. What is gathered is one (doc_id, hash) per part: with these
    bounds each row knows its part, and the first row of a part also goes to the
    part before, as a guest at its end.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rank = corpus_rarity(narrow)
    # Descending, NULL last: places count upwards along the order of documents.
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce(F.col("doc_id"), F.lit(0))).alias("back"), F.xxhash64("text").alias("hash"))
    sizes = written(narrow.select(place.alias("place"), (F.octet_length("text") + 64).cast("long").alias("bytes")))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    if not total:
        return docs.sparkSession.createDataFrame([], _EDITED)
    first = sizes.agg(F.min("place")).first()[0]
    bounds = [tuple(first)]
    parts = min(int(total // part_bytes) + 1, MOST_PARTS)
    if parts > 1:
        ranged = sizes.repartitionByRange(parts, "place").groupBy(F.spark_partition_id().alias("part"))
        starts = {tuple(r[0]) for r in ranged.agg(F.min("place")).select("min(place)").collect()}
        bounds = sorted(starts | {tuple(first)})

    @F.pandas_udf("array<struct<part: int, guest: boolean>>")
    def parts_of(none: pd.Series, back: pd.Series, hashed: pd.Series) -> pd.Series:
        """The part of a row, and for the first row of a part the part before it too."""
        out = []
        for key in zip(none.tolist(), back.tolist(), hashed.tolist()):
            part = bisect_right(bounds, key) - 1
            to = [{"part": part, "guest": False}]
            if bounds[part] == key:
                to.append({"part": (part or len(bounds)) - 1, "guest": True})
            out.append(to)
        return pd.Series(out)

    spread = narrow.select("doc_id", "text", place.alias("place")).withColumn(
        "to", F.explode(parts_of(F.col("place.none"), F.col("place.back"), F.col("place.hash")))
    )
    laid = spread.select("doc_id", "text", "place", "to.part", "to.guest").repartitionByRange(len(bounds), "part")
    laid = laid.sortWithinPartitions("part", "guest", "place").select("doc_id", "text", "guest")
    return laid.mapInArrow(partial(_compare_batches, rarity=rank), _EDITED)

"""Periodic runs of words: suffix arrays, wavelet trees and dyadic blocks, inside whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import GAP, row_slices, ship, text_or_empty

# A run is a stretch of words with smallest period q and at least max(LEAST_LENGTH, TIMES * q) words.
LEAST_LENGTH, TIMES = 24, 3
# Blocks have BASE, 2 * BASE, ... words. A run of period q < 2 * BASE, and one of q from b to 2 * b for a larger
# block b, holds a block at a multiple of b together with its repetition q words on, since 2 * b - 1 + q words
# always suffice for that: 2 * 8 - 1 + 8 < LEAST_LENGTH, and 2 * b - 1 + q < TIMES * q for q >= b.
BASE = 8

_BATCH_BYTES = 1 << 20
_RESULT = (
    "n_words long, n_runs long, runs array<struct<start:long,length:long,period:long>>, "
    "strongest struct<start:long,length:long,period:long>, collapsed string, runs_sha256 string, collapsed_sha256 string"
)


class _Codes(dict):
    """Numbers for the words of one text, from ``begin`` on."""

    def __init__(self, begin: int):
        super().__init__()
        self.begin = begin

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.begin + len(self)
        return value


class WaveletTree:
    """Range successors and predecessors over an array of numbers below 2**bits, many queries at a time.

    Each level holds one bit of every number, from the highest down, in the order
    that the levels above leave: zeros first, ones behind them.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.ones, self.zeros = [], []  # running counts of ones; where the ones begin
        for bit in reversed(range(bits)):
            one = (values >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(one)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of values[lo:hi] are less than ``bound``."""
        lo, hi, count = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        everything = bound >> self.bits > 0
        whole = hi - lo
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            one_lo, one_hi = ones[lo], ones[hi]
            up = (bound >> bit & 1).astype(bool)
            count += np.where(up, (hi - one_hi) - (lo - one_lo), 0)
            lo = np.where(up, zeros + one_lo, lo - one_lo)
            hi = np.where(up, zeros + one_hi, hi - one_hi)
        return np.where(everything, whole, count)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of ``rank`` (from 0) in sorted values[lo:hi]; the rank must exist."""
        lo, hi, rank, found = lo.copy(), hi.copy(), rank.copy(), np.zeros(len(lo), np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            one_lo, one_hi = ones[lo], ones[hi]
            n_zero = (hi - one_hi) - (lo - one_lo)
            up = rank >= n_zero
            rank = np.where(up, rank - n_zero, rank)
            found += np.where(up, 1 << bit, 0)
            lo = np.where(up, zeros + one_lo, lo - one_lo)
            hi = np.where(up, zeros + one_hi, hi - one_hi)
        return found

    def progressions(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, most: np.ndarray):
        """Of the numbers of values[lo:hi] from ``least`` to ``most``: which queries have any, the first, the step and the last.

        The successors of ``least`` and of what it finds give the first and the step.
        """
        before, upto = self.below(lo, hi, least), self.below(lo, hi, most + 1)
        any_ = np.flatnonzero(upto > before)
        lo, hi, before, upto = lo[any_], hi[any_], before[any_], upto[any_]
        first = self.smallest(lo, hi, before)
        second = self.smallest(lo, hi, np.minimum(before + 1, upto - 1))
        last = self.smallest(lo, hi, upto - 1)
        return any_, first, np.maximum(second - first, 1), last


class _Ranks:
    """Ranks of all stretches of 1, 2, 4, ... words of a batch of texts, by prefix doubling.

    ``levels[k][i]`` is the same for two places exactly where the 2**k words from
    there on are the same. From two words on, only places whose stretch occurs again in its
    text have a rank, others have -1. The doubling ends where no stretch occurs twice.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        """``words`` are numbers below the number of places, other ones in each text; ``ends`` has the end of its text for every place."""
        self.levels = [words]
        width, level = 1, 0
        n = len(words)
        places = np.arange(n)
        while len(places):
            # Stretches that would run over the end of a text are no stretches.
            inside = places + 2 * width <= ends[places]
            places = places[inside]
            ranks = self.levels[level]
            follows = ranks[places + width]
            places, follows = places[follows >= 0], follows[follows >= 0]
            key = ranks[places] * np.int64(n + 1) + follows
            order = np.argsort(key, kind="stable")
            key, places = key[order], places[order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
            begins = np.flatnonzero(fresh)
            sizes = np.diff(np.append(begins, len(key)))
            group = np.cumsum(fresh) - 1
            again = sizes[group] > 1
            places, group = places[again], group[again]
            table = np.full(n, -1, np.int64)
            table[places] = group
            self.levels.append(table)
            width, level = 2 * width, level + 1

    def at(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ranks at ``places``, -1 outside the batch."""
        inside = (places >= 0) & (places < len(self.levels[0]))
        return np.where(inside, self.levels[level][np.where(inside, places, 0)], -1)

    def common(self, a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many words agree from places a and b on (``backwards``: before them), a < b."""
        length = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels))):
            step = 1 << level
            shift = -length - step if backwards else length
            x, y = self.at(level, a + shift), self.at(level, b + shift)
            length += np.where((x == y) & (x >= 0), step, 0)
        return length


def _suffix_array(ranks: _Ranks, level: int) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The places with a rank at ``level``, in the order of what follows them, and the intervals of their groups by level.

    Ordered by the ranks of all levels, from short stretches to long ones: every
    group of equal stretches of any level is an interval.
    """
    places = np.flatnonzero(ranks.levels[level] >= 0)
    keys = [ranks.levels[k][places] for k in range(level, len(ranks.levels))]
    order = np.lexsort(keys[::-1])
    places = places[order]
    intervals = {}
    for k, key in enumerate(keys, level):
        key = key[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (key[1:] < 0)]) if len(key) else np.empty(0, bool)
        begins = np.flatnonzero(fresh)
        ends = np.append(begins[1:], len(key))
        group = np.cumsum(fresh) - 1
        intervals[k] = begins[group], ends[group]
    return places, intervals


def runs_of(words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """All runs of a batch of texts, as rows (first word, end, period), ordered.

    ``words`` holds a number below their count for every word, the same for the same word of one
    text and for no word of another; text t has those from begins[t] to begins[t + 1]. For every dyadic block, the places where it occurs again within its own
    length (twice for BASE) behind its beginning are found by range successors over the
    suffix array. Fewer than three, or in arithmetic progression, they are given by first, step and last; each distance is a
    candidate period, tested by extending it both ways.
    """
    sizes = np.diff(begins)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if not len(text):
        return np.empty((0, 3), np.int64)
    ranks = _Ranks(words, begins[1:][text])
    base = BASE.bit_length() - 1
    if len(ranks.levels) <= base or not (ranks.levels[base] >= 0).any():
        return np.empty((0, 3), np.int64)
    array, intervals = _suffix_array(ranks, base)
    tree = WaveletTree(array, int(len(text)).bit_length())
    found = []
    for level, (lo, hi) in intervals.items():
        size = 1 << level
        blocks = np.flatnonzero((hi - lo > 1) & ((array - begins[text[array]]) % size == 0))
        windows = [(size, 2 * size - 1)] if size > BASE else [(1, size - 1), (size, 2 * size - 1)]
        for least, most in windows:
            place = array[blocks]
            any_, first, step, last = tree.progressions(lo[blocks], hi[blocks], place + least, place + most)
            many = (last - first) // step + 1
            place = np.repeat(place[any_], many)
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            period = np.repeat(first, many) + inside * np.repeat(step, many) - place
            start = place - ranks.common(place, place + period, backwards=True)
            end = place + period + ranks.common(place, place + period)
            long = end - start >= np.maximum(LEAST_LENGTH, TIMES * period)
            found.append(np.stack([start, end, period], axis=1)[long])
    rows = np.unique(np.concatenate(found), axis=0)
    # Of one stretch the smallest period counts: the others are its multiples.
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _run_batches(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for whole in batches:
        for batch in row_slices(whole, 0, _BATCH_BYTES):
            # bytes.split cuts at exactly the six ASCII blanks.
            texts = [v.as_buffer().to_pybytes().split() for v in batch.column(0)]
            begins = np.cumsum([0, *map(len, texts)])
            codes = [np.empty(0, np.int64)]
            for begin, t in zip(begins.tolist(), texts):
                codes.append(np.fromiter(map(_Codes(begin).__getitem__, t), np.int64, len(t)))
            words = np.concatenate(codes)
            rows = runs_of(words, begins)
            cuts = np.searchsorted(rows[:, 0], begins)
            rows_out = []
            for t, words_of in enumerate(texts):
                own = rows[cuts[t] : cuts[t + 1]] - [begins[t], begins[t], 0]
                listed = [(start, end - start, period) for start, end, period in own.tolist()]
                kept = words_of
                if listed:
                    depth = np.zeros(len(words_of) + 1, np.int64)
                    np.add.at(depth, own[:, 0] + own[:, 2], 1)
                    np.add.at(depth, own[:, 1], -1)
                    kept = [words_of[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                collapsed = b" ".join(kept)
                text = "".join(f"{start},{length},{period}\n" for start, length, period in listed)
                named = [dict(zip(("start", "length", "period"), r)) for r in listed]
                best = max(listed, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                rows_out.append(
                    (
                        len(words_of),
                        len(listed),
                        named,
                        named[listed.index(best)] if best else None,
                        collapsed.decode() if keep_text else None,
                        sha256(text.encode()).hexdigest(),
                        sha256(collapsed).hexdigest(),
                    )
                )
            kinds = (pa.int64(), pa.int64(), pa.list_(struct), struct, pa.string(), pa.string(), pa.string())
            names = ["n_words", "n_runs", "runs", "strongest", "collapsed", "runs_sha256", "collapsed_sha256"]
            found = [pa.array(c, k) for c, k in zip(list(zip(*rows_out)) or [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], names=[*batch.schema.names[1:], *names])


def find_runs(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """All periodic runs of words of every text, and the text without their repetitions.

    Takes doc_id and text; returns doc_id, n_words, n_runs, ``runs`` (start, length and period in
    words, by start, then period), ``strongest`` (the run of greatest length / period, NULL if there is none; ties by
    start, then period), ``collapsed`` (NULL without ``keep_text``), and the SHA-256 of the runs written as ``start,length,period`` lines and of the collapsed text. A run can't be
    extended by a neighbouring word, has at least LEAST_LENGTH words and
    TIMES periods, and is named by its smallest period. Of each run the first period stays; a word
    that any run repeats goes, and the words left are joined by one space.

    NULL, empty and blank texts have no words and no run. Rows with a NULL doc_id
    and repeated rows are each answered. Texts are never split over tasks: a task needs
    some 8 bytes per word for each power of two up to the longest stretch that occurs
    again in a text of its batch, and batches hold one megabyte or one text.
    """
    ship(docs.sparkSession)
    narrow = docs.select(text_or_empty().cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return narrow.mapInArrow(partial(_run_batches, keep_text=keep_text), "doc_id long, " + _RESULT)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by the checksum of its doc_id) goes on periodically.

    With h the unsigned CRC-32 of the decimal doc_id, g = h div 10 and n words, in
    documents with h % 10 = 0 word i >= a is word a + (i - a) % p, for a = g % n and
    p = 1 + (n - a) div (3 + g % 8). Other texts, and those of a NULL doc_id, stay as they are.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", GAP), lambda w: w != "")).otherwise(F.expr("cast(array() as array<string>)"))
    cut = base.withColumns({"_words": words, "_h": h}).withColumns({"_g": F.expr("_h div 10"), "_n": F.size("_words").cast("long")})
    cut = cut.withColumn("_a", F.expr("if(_n > 0, _g % _n, null)"))
    cut = cut.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    head = "slice(_words, 1, cast(_a as int))"
    period = "slice(_words, cast(_a + 1 as int), cast(_p as int))"
    tail = f"slice(flatten(array_repeat({period}, cast((_n - _a + _p - 1) div _p as int))), 1, cast(_n - _a as int))"
    planted = F.expr(f"array_join(concat({head}, {tail}), ' ')")
    return cut.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))

"""Best-fit packing of token sequences, in bulk steps over all documents of a length."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache, partial
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import row_numbers, row_slices, ship, written
from tallyroll.llm.tokens import tokenizer_at

CAPACITY = 2048
END_ID = 0
_BATCH_BYTES = 4 << 20
_KNOWN_PARTS = 800_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class _WordIds:
    """Token ids of texts as little-endian bytes; those of pre-tokens are remembered while there are few.

    The tokenizer composes and lower-cases the text, drops white space and cuts the rest into runs of
    letters, single digits and runs of other signs, and no token crosses such a cut. In a text of
    Latin letters that are one character in lower case, ASCII digits, punctuation and white space, composing
    changes nothing and the cuts are those of ``PART``. Many new pre-tokens are encoded
    as one text: each ends with the one token that closes it. Other texts are cut at the six ASCII blanks;
    words that are simple are treated the same way and others encoded as they are.
    """

    # U+0130 is left out: in lower case it is a letter and a mark, and the mark joins the signs behind it.
    LETTERS = "A-Za-zÀ-ÖØ-öø-įıĲ-ʯ"
    SIMPLE = re.compile(rf"[{LETTERS}0-9!-/:-@\[-`{{-~ \t-\r]*")
    # Of a simple text in lower case; two of the letters have a small one far outside.
    PART = re.compile(r"'(?:[sdmt]|ll|ve|re)|[^\W\d_]+|[0-9]|[!-/:-@\[-`{-~]+")
    TOGETHER = 1024

    def __init__(self, path: str):
        self.tokenizer = tokenizer_at(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _cut(self, text: str) -> list[str] | None:
        """The pre-tokens of a simple text."""
        if not self.SIMPLE.fullmatch(text) or self.special.search(text):
            return None
        return self.PART.findall(text.lower())

    def _learn(self, parts: list[str]) -> None:
        groups = [parts[i : i + self.TOGETHER] for i in range(0, len(parts), self.TOGETHER)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                data = ids.tobytes()
                begins = [0, *(4 * ends[:-1]).tolist()]
                self.parts.update((p, data[a:b]) for p, a, b in zip(group, begins, (4 * ends).tolist()))
            else:
                self.parts.update((p, i.tobytes()) for p, i in zip(group, self._encode(group)))

    def _joined(self, cut: Iterable[list[str] | None]) -> list[bytes | None]:
        """Ids from pre-tokens; None where there are none."""
        if len(self.parts) > _KNOWN_PARTS:
            self.parts.clear()
        out, waiting = [], []
        get = self.parts.get
        for i, parts in enumerate(cut):
            found = None if parts is None else list(map(get, parts))
            if found and None in found:
                waiting.append((i, parts))
                found = None
            out.append(None if found is None else b"".join(found))
        self._learn(list(set(chain.from_iterable(parts for _, parts in waiting)).difference(self.parts)))
        for i, parts in waiting:
            out[i] = b"".join(map(self.parts.__getitem__, parts))
        return out

    def _by_words(self, texts: list[bytes]) -> list[bytes]:
        # Other white space than the six blanks stays inside a word and is left to the tokenizer.
        split = [[w.decode() for w in t.split()] for t in texts]
        words = list(set(chain.from_iterable(split)))
        known = dict(zip(words, self._joined(map(self._cut, words))))
        others = [w for w in words if known[w] is None]
        known.update((w, i.tobytes()) for w, i in zip(others, self._encode(others)))
        return [b"".join(map(known.__getitem__, t)) for t in split]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        out = self._joined(self._cut(t.decode()) for t in texts)
        others = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(others, self._by_words([texts[i] for i in others])):
            out[i] = found
        return out


@lru_cache(maxsize=1)
def _words_of(path: str) -> _WordIds:
    """One memory per worker process, over all its tasks."""
    return _WordIds(path)


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    words = _words_of(path)
    end = np.array([END_ID], "<u4").tobytes()
    for whole in batches:
        for batch in row_slices(whole, 1, _BATCH_BYTES):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, crc32(part), part if keep_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids and an end id; only longer ones are cut."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    work = partial(_piece_batches, path=str(tokenizer), capacity=capacity, keep_ids=keep_ids)
    pieces = narrow.mapInArrow(work, _PIECES)
    return pieces if keep_ids else pieces.drop("ids")


# --- matching ---------------------------------------------------------------
RUN_FIELDS = ("length", "first_rank", "sequence", "per_sequence", "offset")


def match_lengths(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best fit for all documents, as runs, from how many there are of each length.

    One step handles all documents of one length, longest first. Its successor
    sweep goes over the open gaps in order of size: the documents, by rank,
    take the smallest gaps that hold them, each gap as many as fit; those still
    left over open sequences of their own. The changed gaps enter the order
    before the next step.

    Returns runs (see RUN_FIELDS): from ``first_rank`` on, documents of that
    length go to ``sequence`` and those after it, ``per_sequence`` to each, from
    ``offset`` on. Also the number of sequences. Gaps of one size and origin stay
    one entry, so the work depends on the lengths that occur, never on how many
    documents have them.
    """
    runs: list[tuple] = []
    sizes: list[int] = []  # of open gaps, in order
    gaps: dict[int, deque] = defaultdict(deque)  # size -> (first sequence, how many)
    sequences = 0

    def open_gap(size: int, first: int, many: int) -> None:
        if size and many:
            if not gaps[size]:
                insort(sizes, size)
            gaps[size].append((first, many))

    def fill(size: int, first: int, many: int, length: int, rank: int, waiting: int) -> int:
        """Puts waiting documents into ``many`` equal gaps; returns how many went in."""
        each = size // length
        full = min(many, waiting // each)
        if full:
            runs.append((length, rank, first, each, capacity - size))
            open_gap(size - each * length, first, full)
        rest = waiting - full * each
        if full < many and rest:
            runs.append((length, rank + full * each, first + full, rest, capacity - size))
            open_gap(size - rest * length, first + full, 1)
            open_gap(size, first + full + 1, many - full - 1)
            return waiting
        open_gap(size, first + full, many - full)
        return full * each

    for length in sorted(counts, reverse=True):
        rank, waiting = 0, counts[length]
        while waiting:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, many = gaps[size].popleft()
                if not gaps[size]:
                    sizes.pop(at)
            else:
                size, first, many = capacity, sequences, -(-waiting // (capacity // length))
                sequences += many
            placed = fill(size, first, many, length, rank, waiting)
            rank, waiting = rank + placed, waiting - placed
    return runs, sequences


def pack(
    docs: DataFrame, tokenizer: str | None = None, *, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """Pieces with their place in sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset for every
    row of ``docs`` (doc_id, text), and with ``keep_ids`` the ids themselves as
    little-endian unsigned 32-bit numbers. ``tokenizer`` must drop white space and
    be a path that workers can open. NULL, empty and blank texts are one end id.
    Repeated rows are packed each; ties go by length, doc_id, piece and checksum.

    Pieces are range-sorted by length and get their rank in it. What is gathered
    to match ranks with gaps is one count per length (``capacity`` at most).
    """
    ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = written(cut_pieces(docs, path, capacity, keep_ids))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = match_lengths(counts, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, len(RUN_FIELDS))
    lengths = np.array(sorted(counts), np.int64)
    begins = np.concatenate([[0], np.cumsum([counts[n] for n in sorted(counts)])]).astype(np.int64)
    # Runs in the order of the global ranks of the documents that they begin with.
    run_begins = begins[np.searchsorted(lengths, table[:, 0])] + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(row: pd.Series) -> pd.DataFrame:
        rank = row.to_numpy()
        at = np.searchsorted(run_begins, rank, side="right") - 1
        length, _, sequence, each, offset = table[at].T
        turn = rank - run_begins[at]
        return pd.DataFrame({"sequence_id": sequence + turn // each, "offset": offset + turn % each * length})

    ranked = row_numbers(pieces, ["length", "doc_id", "piece", "ids_crc32"], "_rank")
    return ranked.withColumn("_place", place("_rank")).select(*pieces.columns, "_place.*")

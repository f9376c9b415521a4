"""Token counts as a public tokenizer gives them, with huge documents encoded in overlapping chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyroll.llm.common import row_slices, ship, text_or_empty

LIMIT = 512
CHUNK, OVERLAP = 32_768, 1_024  # characters
_BATCH_BYTES = 4 << 20
_KNOWN_UNITS = 300_000


@lru_cache(maxsize=4)
def tokenizer_at(path: str) -> Tokenizer:
    """One tokenizer per worker process."""
    return Tokenizer.from_file(path)


def stable(text: str, at: int) -> bool:
    """Whether byte-level BPE always begins a token at ``at``.

    A lone space between two characters that are no white space is such a place:
    no pre-token runs over it to the left, the space opens the next one, and no
    special token holds a space. ``str.isspace`` knows all white space that the
    pre-tokenizer knows and a little more, so this errs to the safe side.
    """
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def count_by_chunks(
    text: str, starts_of: Callable[[str], list[int]], chunk: int = CHUNK, overlap: int = OVERLAP
) -> int:
    """Tokens of ``text`` from overlapping chunks, spliced where both begin a token at a stable place.

    ``starts_of`` gives the character at which each token of a string begins. If
    an overlap holds no common stable boundary, the overlap is doubled; once it
    covers the whole chunk before, the two chunks become one.
    """
    begin, end = 0, min(chunk, len(text))
    starts = starts_of(text[begin:end])
    spliced, total = 0, 0
    while end < len(text):
        width = min(overlap, end - begin)
        upto = min(end + chunk, len(text))
        while True:
            first = end - width
            following = [first + s for s in starts_of(text[first:upto])]
            known = set(following)
            # Both chunks must see the characters on either side of the boundary.
            common = next(
                (s for s in starts if s > max(first, spliced) and s < end - 1 and s in known and stable(text, s)), None
            )
            if common is not None:
                total += sum(spliced <= s < common for s in starts)
                spliced, begin, starts = common, first, following
                break
            if width >= end - begin:
                starts = [begin + s for s in starts_of(text[begin:upto])]
                break
            width = min(2 * width, end - begin)
        end = upto
    return total + sum(s >= spliced for s in starts)


class _UnitCounts:
    """Tokens of the stretches between lone spaces, remembered while there are few.

    A lone space between other characters is a stable boundary, so the stretches
    of a text are encoded independently and their counts add up.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def _learn(self, known: dict[str, int], pieces: set[str], before: str) -> None:
        missing = list(pieces.difference(known))
        encoded = self.tokenizer.encode_batch_fast([before + p for p in missing], add_special_tokens=False)
        for piece, e in zip(missing, encoded):
            # A piece that is empty or has white space at an end makes its boundaries unsafe.
            safe = piece and not piece[0].isspace() and not piece[-1].isspace()
            known[piece] = len(e) if safe else -1

    def counts(self, texts: list[str]) -> list[int]:
        for known in (self.first, self.later):
            if len(known) > _KNOWN_UNITS:
                known.clear()
        split = [t.split(" ") for t in texts]
        self._learn(self.first, {p[0] for p in split}, "")
        self._learn(self.later, {piece for p in split for piece in p[1:]}, " ")
        out = []
        for text, pieces in zip(texts, split):
            found = [self.first[pieces[0]], *map(self.later.__getitem__, pieces[1:])]
            if min(found) < 0:
                found = [len(self.tokenizer.encode(text, add_special_tokens=False))]
            out.append(sum(found))
        return out


def _count_batches(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    tokenizer = tokenizer_at(path)
    units = _UnitCounts(tokenizer)

    def starts_of(part: str) -> list[int]:
        return [s for s, _ in tokenizer.encode(part, add_special_tokens=False).offsets]

    for whole in batches:
        for batch in row_slices(whole, 2, _BATCH_BYTES):
            texts = batch.column(2).to_pylist()
            counts = [0 if len(t) <= chunk else count_by_chunks(t, starts_of, chunk, overlap) for t in texts]
            short = [i for i, t in enumerate(texts) if t and len(t) <= chunk]
            for i, n in zip(short, units.counts([texts[i] for i in short])):
                counts[i] = n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )


def count_tokens(
    docs: DataFrame,
    tokenizer: str | None = None,
    *,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a byte-level BPE file that workers can open.
    Texts longer than ``chunk`` characters are encoded in overlapping chunks.
    NULL texts count as empty: 0 bytes, 0 tokens. Repeated rows are counted each.
    """
    ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    text = text_or_empty()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = narrow.mapInArrow(
        partial(_count_batches, path=str(path), chunk=chunk, overlap=overlap), "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

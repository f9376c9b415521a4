"""Token ids of a corpus in files of compressed byte or bit planes, with an index of chunks and documents.

One file holds the documents of one range partition:

    MAGIC, the chunks, the index (zstd), the index's place and size (16 bytes), MAGIC

A chunk holds BLOCK ids (the last one fewer) as unsigned 32-bit numbers, transposed into planes: plane k has
byte k (or bit k) of every id. High planes of a small vocabulary are all zeros and the others hold like
bytes side by side, so each plane is compressed on its own. The index names, for every chunk, its place, its
number of ids and the compressed size of each plane, and, for every document in order, its doc_id and
its number of ids. So any range of ids is read from its own chunks alone.
"""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import accumulate, chain
from pathlib import Path
from urllib.parse import urlparse
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tallyroll.llm.common import row_slices, ship, text_or_empty, written
from tallyroll.llm.tokens import tokenizer_at
from tallyroll.session import new_folder

MAGIC = b"TALLYID1"
BLOCK = 65_536  # ids in a chunk
PLANES = {"bytes": 4, "bits": 32}
LEVEL = 1  # of zstd
END_ID = 2

_BATCH_BYTES = 4 << 20
_KNOWN_UNITS, _KNOWN_PARTS = 300_000, 800_000
_MANIFEST = "part int, file string, n_docs long, n_ids long"


# --- ids of texts -----------------------------------------------------------
class _Memory:
    """A dict that forgets what was not asked for lately: of two generations the older one goes."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that are not known; the others are in ``now`` after this."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now
        unknown = keys.difference(self.now)
        if self.before:
            old = unknown.intersection(self.before)
            self.now.update((k, self.before[k]) for k in old)
            unknown -= old
        return list(unknown)


class _Learnt(dict):
    """A dict that learns what is not in it when it is asked for, with a generation before it as in ``_Memory``."""

    def __init__(self, learn: Callable[[str], bytes], before: dict[str, bytes]):
        self.learn, self.before = learn, before

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.learn(key)
        self[key] = found
        return found


class TextIds:
    """Ids of whole texts under a byte-level BPE file, as bytes of little-endian numbers of ``kind``.

    A text of Latin letters, ASCII digits, punctuation and white space is cut into pre-tokens by
    the tokenizer's own pattern over these classes. The ids of pre-tokens are remembered, and a new one is
    given to the tokenizer's model as its pre-tokenizer spells it, without cutting it again, so that a text's
    pre-tokens are looked up once, whether they are known or not. Any other text is cut
    at lone spaces, where a token always begins (see ``tokens.stable``); stretches are treated the same way
    if they are that simple and encoded as they are if not.
    """

    LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
    # The pre-tokenizer's pattern, with its classes cut down to Latin letters, ASCII digits, punctuation and white space.
    PART = re.compile(
        r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-zÀ-ÖØ-öø-ʯ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
    )
    LETTERS = 0x2B0  # the code points of PART lie below

    def __init__(self, path: str):
        self.tokenizer = tokenizer_at(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        self.spelling = self._spelling()
        self.parts, self.stretches = _Learnt(self._learn, {}), _Memory(_KNOWN_UNITS)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> list[str] | None:
        """The pre-tokens of a simple text."""
        found = self.PART.findall(text)
        return found if sum(map(len, found)) == len(text) and not self.special.search(text) else None

    def _spelling(self) -> dict[int, str] | None:
        """How the model sees each character of simple texts; None if more happens before the model than this."""
        cutter = self.tokenizer.pre_tokenizer
        plain = self.tokenizer.normalizer is None and isinstance(cutter, ByteLevel) and not cutter.add_prefix_space
        if not plain or not cutter.use_regex or self.tokenizer.post_processor is not None:
            return None
        speller = ByteLevel(add_prefix_space=False, use_regex=False)
        return {c: speller.pre_tokenize_str(chr(c))[0][0] for c in range(1, self.LETTERS)}

    def _learn(self, part: str) -> bytes:
        """Ids of one new pre-token."""
        if self.spelling is None:
            return self._encode([part])[0].tobytes()
        return array(self.kind.char, [t.id for t in self.tokenizer.model.tokenize(part.translate(self.spelling))]).tobytes()

    def _joined(self, cut: Iterable[list[str] | None]) -> list[bytes | None]:
        """Ids from pre-tokens; None where there are none."""
        if len(self.parts) > _KNOWN_PARTS:
            self.parts.before = {}
            self.parts = _Learnt(self._learn, self.parts)
        known = self.parts.__getitem__
        return [None if parts is None else b"".join(map(known, parts)) for parts in cut]

    def _stretches(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are not simple, by their stretches between lone spaces."""
        split = []
        for text in texts:
            first, *later = self.LONE_SPACE.split(text)
            split.append([first, *(" " + s for s in later)])
        unknown = self.stretches.missing(set(chain.from_iterable(split)))
        known = self.stretches.now
        known.update(zip(unknown, self._joined(map(self._cut, unknown))))
        others = [s for s in unknown if known[s] is None]
        known.update((s, i.tobytes()) for s, i in zip(others, self._encode(others)))
        return [b"".join(map(known.__getitem__, parts)) for parts in split]

    def ids(self, texts: list[str]) -> list[bytes]:
        out = self._joined(map(self._cut, texts))
        others = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(others, self._stretches([texts[i] for i in others])):
            out[i] = found
        return out


@lru_cache(maxsize=1)
def _ids_of(path: str) -> TextIds:
    """One memory per worker process, over all its tasks."""
    return TextIds(path)


# --- files ------------------------------------------------------------------
def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Where a folder or file lies, for code outside the JVM; any address that Arrow knows."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parsed.path
    return pafs.FileSystem.from_uri(uri)


def to_planes(ids: np.ndarray, planes: str) -> np.ndarray:
    """[plane, place] of unsigned 32-bit ids: bytes, or bits packed eight to a byte."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bytes":
        return np.ascontiguousarray(octets.T)
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little"))


def from_planes(rows: list[bytes], n: int, planes: str) -> np.ndarray:
    table = np.stack([np.frombuffer(r, np.uint8) for r in rows])
    if planes == "bits":
        bits = np.unpackbits(table, axis=1, count=n, bitorder="little")
        table = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(table.T).view("<u4").ravel()


class IdFileWriter:
    """Writes documents one after another; holds one chunk, and the numbers of the index."""

    def __init__(self, file, planes: str = "bytes", block: int = BLOCK, level: int = LEVEL):
        if planes not in PLANES:
            raise ValueError(f"planes are one of {', '.join(PLANES)}")
        self.file, self.planes, self.block = file, planes, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.chunks: list[list[int]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.at = file.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block:
            whole = np.concatenate(self.held)
            full = len(whole) - len(whole) % self.block
            for a in range(0, full, self.block):
                self._chunk(whole[a : a + self.block])
            self.held, self.n_held = [whole[full:].copy()], len(whole) - full

    def _chunk(self, ids: np.ndarray) -> None:
        rows = [self.zstd.compress(plane) for plane in to_planes(ids, self.planes)]
        self.chunks.append([self.at, len(ids), *map(len, rows)])
        self.at += sum(map(self.file.write, rows))

    def close(self) -> None:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        known = [d is not None for d in self.doc_ids]
        arrays = {
            "chunks": np.array(self.chunks, "<i8").ravel(),
            "doc_ids": np.array([d or 0 for d in self.doc_ids], "<i8"),
            "known": np.array(known, "<i8"),
            "lengths": np.array(self.lengths, "<i8"),
        }
        head = json.dumps({"planes": self.planes, "block": self.block, "sizes": {k: len(v) for k, v in arrays.items()}}).encode()
        index = self.zstd.compress(b"".join([len(head).to_bytes(8, "little"), head, *(v.tobytes() for v in arrays.values())]))
        self.file.write(index)
        self.file.write(self.at.to_bytes(8, "little") + len(index).to_bytes(8, "little") + MAGIC)
        self.file.close()


class IdFile:
    """Reads a file of ``IdFileWriter`` by its index; only the chunks asked for are fetched."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(24, size - 24) if size >= 24 else b""
        if tail[16:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no whole file of token ids")
        at, length = (int.from_bytes(tail[i : i + 8], "little") for i in (0, 8))
        self.zstd = zstandard.ZstdDecompressor()
        index = self.zstd.decompress(self.file.read_at(length, at))
        begin = 8 + int.from_bytes(index[:8], "little")
        head = json.loads(index[8:begin])
        self.planes = head["planes"]
        found = {}
        for name, n in head["sizes"].items():
            found[name] = np.frombuffer(index, "<i8", n, begin)
            begin += 8 * n
        self.chunks = found["chunks"].reshape(-1, 2 + PLANES[self.planes])
        self.doc_ids = [int(d) if k else None for d, k in zip(found["doc_ids"], found["known"])]
        self.lengths = found["lengths"]
        self.chunk_ends = np.cumsum(self.chunks[:, 1])

    def chunk(self, i: int) -> np.ndarray:
        at, n, *sizes = self.chunks[i].tolist()
        data = memoryview(self.file.read_at(sum(sizes), at))
        ends = list(accumulate(sizes, initial=0))
        return from_planes([self.zstd.decompress(data[a:b]) for a, b in zip(ends, ends[1:])], n, self.planes)

    def ids(self, first: int, stop: int) -> np.ndarray:
        """Ids ``first`` to ``stop`` (not included) of the file."""
        parts, i = [np.empty(0, "<u4")], int(np.searchsorted(self.chunk_ends, first, side="right"))
        while i < len(self.chunks) and self.chunk_ends[i] - self.chunks[i, 1] < stop:
            begin = int(self.chunk_ends[i] - self.chunks[i, 1])
            parts.append(self.chunk(i)[max(first - begin, 0) : stop - begin])
            i += 1
        return np.concatenate(parts)

    def documents(self) -> Iterator[tuple[int | None, int, int, Iterable[np.ndarray]]]:
        """doc_id, place of its first id, number of ids, and the ids by stretches; each chunk is decoded once."""
        at, i, held, begin = 0, -1, np.empty(0, "<u4"), 0
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            parts, first = [], at
            while at < first + n:
                if at >= begin + len(held):
                    begin, i = begin + len(held), i + 1
                    held = self.chunk(i)
                part = held[at - begin : first + n - begin]
                parts.append(part)
                at += len(part)
            yield doc_id, first, n, parts


# --- Spark ------------------------------------------------------------------
def _write_batches(
    batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int | None, planes: str, block: int, level: int
) -> Iterator[pa.RecordBatch]:
    texts = _ids_of(path)
    end = np.array([] if end_id is None else [end_id], "<u4")
    part, writer, uri = TaskContext.get().partitionId(), None, ""
    for whole in batches:
        for batch in row_slices(whole, 1, _BATCH_BYTES):
            if not batch.num_rows:
                continue
            if writer is None:
                # Every attempt has a file of its own; the rows of the one that succeeds name it.
                uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
                system, place = _file_system(uri)
                writer = IdFileWriter(system.open_output_stream(place), planes, block, level)
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts.ids(batch.column(1).to_pylist())):
                writer.add(doc_id, np.concatenate([np.frombuffer(ids, texts.kind).astype("<u4"), end]))
    if writer is not None:
        writer.close()
        row = {"part": part, "file": uri, "n_docs": len(writer.lengths), "n_ids": writer.n_ids}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))


def write_ids(
    docs: DataFrame,
    folder: str | None = None,
    tokenizer: str | None = None,
    *,
    end_id: int | None = END_ID,
    planes: str = "bytes",
    block: int = BLOCK,
    level: int = LEVEL,
) -> DataFrame:
    """Writes the ids of all ``docs`` (doc_id, text) in ascending doc_id order; returns the manifest.

    The manifest has part, file, n_docs, n_ids and ``start``, the ids in all files
    before it: one row per file that counts. Rows are range-sorted by doc_id (NULL first),
    then by a hash of the text and the text, so a repeated doc_id may fill several files.
    ``folder`` is one that every executor reaches, by default one in the shared
    folder that goes with the application; a path or an address that Arrow opens.
    ``tokenizer`` is the path of a byte-level BPE file.

    A NULL text is empty: its only id is ``end_id`` (none if that is None). Repeated
    rows are written each. An empty table gives an empty manifest. A task that
    is run again writes another file, and only the file of the attempt that
    succeeded is in the manifest. A task holds one batch of texts, one chunk of ids, and
    three numbers for each document of its file.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_folder(spark)
    system, place = _file_system(folder)
    if isinstance(system, pafs.LocalFileSystem):
        Path(place).mkdir(parents=True, exist_ok=True)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = narrow.withColumn("_hash", F.xxhash64("text")).repartitionByRange("doc_id", "_hash")
    ordered = ordered.sortWithinPartitions("doc_id", "_hash", "text").select("doc_id", "text")
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    work = partial(_write_batches, folder=folder, path=str(path), end_id=end_id, planes=planes, block=block, level=level)
    manifest = written(ordered.mapInArrow(work, _MANIFEST))
    # One row per file, which is one per range partition.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def _read_batches(batches: Iterator[pa.RecordBatch], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(kinds + [("ids", pa.binary())] * keep_ids)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            rows, held = [], 0
            for doc_id, first, n, parts in IdFile(uri).documents():
                check, kept = 0, []
                for part in parts:
                    data = part.tobytes()
                    check = crc32(data, check)
                    kept += [data] * keep_ids
                rows.append((doc_id, start + first, n, check, *([b"".join(kept)] * keep_ids)))
                held += 1 + n * keep_ids
                if held >= BLOCK:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_ids(manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """What the files of ``manifest`` hold: doc_id, start, n_tokens, ids_crc32, and with ``keep_ids`` the ids.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the
    unsigned checksum of the ids as little-endian unsigned 32-bit numbers, which ``ids`` holds. One
    task reads one file or few, chunk by chunk.
    """
    ship(manifest.sparkSession)
    files = written(manifest.select("part", "file", "start"))
    dealt = files.repartitionByRange(max(files.count(), 1), "part").select("file", "start")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return dealt.mapInArrow(partial(_read_batches, keep_ids=keep_ids), schema)

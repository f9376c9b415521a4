"""Fuzzy line dedup: signatures of normalised lines, pigeonhole blocks, edit similarity, one line per group."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tallyroll.llm.common import maybe_among, mix64, packed, row_slices, scratch, ship, text_or_empty, written
from tallyroll.llm.components import connected_components

SIMILARITY = 85  # percent: 100 * (1 - edits / longer length)
# Lines meet if their SimHashes agree in three of four 16-bit blocks, as they do when one block holds all
# different bits, or if their signatures of least gram hashes agree in one of BANDS blocks of ROWS.
SIM_BLOCKS = 4
BANDS, ROWS = 8, 3
# Grams of short lines have SHORT characters, those of others LONG. Lines of similar length around EDGE have both.
SHORT, LONG, EDGE = 4, 8, 64
# One edit changes much of a line under TINY characters: such lines also meet in blocks of TINY_ROWS hashes.
TINY, TINY_ROWS = 32, 2
# Of two long candidates' signatures, of which a byte of each hash is kept, so many of BANDS * ROWS must agree. At an edit
# similarity of 0.85 an estimated half or more do if the edits are close together, and some eight if they are spread over
# all words; of unrelated lines that met in one block, the three of the block and one in 256 of the others.
AGREE = 5
# Of a short line ``pair_bits`` are kept instead, in as many bytes: they may differ by what so many edits can change.
SALT = 64  # members of a key in one block of the last comparison

_BATCH_BYTES = 1 << 17  # of text, so that a batch in numbers of 8 bytes stays in the cache
_BYTE = 24  # the kept byte's place in a hash: the highest bits of a least hash are zeros in any long line
_VALUES = 16_384  # that stay in the processor's cache over all hashes
_PAIRS = 512  # of lines whose counts stay there too
_LINES = "doc_id long, text_hash long, place int, class_a long, class_b long, n_chars int, s0 long, s1 long, s2 long, keys array<long>"


def normalised(line: Column) -> Column:
    """Letters and digits only, in lower case, single spaces between words."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


# --- signatures, inside tasks ------------------------------------------------
_IS_WORD = np.full(sys.maxunicode + 1, -1, np.int8)  # of each code point, once it has been seen


def _letters_and_digits(codes: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter or a digit."""
    found = _IS_WORD[codes]
    if (found < 0).any():
        new = np.unique(codes[found < 0])
        _IS_WORD[new] = [chr(c).isalnum() for c in new.tolist()]
        found = _IS_WORD[codes]
    return found > 0


def normal_lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All lines of ``texts`` that are not blank in normal form: their code points one after another, ends, texts and places.

    Letters and digits only, in lower case, single spaces between words.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le"), "<u4")
    line = np.cumsum(codes == 10)
    kept = np.flatnonzero(_letters_and_digits(codes))
    if not len(kept):
        return np.empty(0, np.uint32), *(np.empty(0, np.int64) for _ in range(3))
    line = line[kept]
    opens = np.concatenate([[True], line[1:] != line[:-1]])
    gap = np.concatenate([[False], np.diff(kept) > 1]) & ~opens
    at = np.arange(len(kept)) + np.cumsum(gap)
    chars = np.full(int(at[-1]) + 1, 32, np.uint32)
    chars[at] = codes[kept]
    ends = np.append(at[opens][1:], len(chars))
    n_lines = np.array([t.count("\n") + 1 for t in lowered])
    firsts = np.cumsum(n_lines) - n_lines
    numbers = line[opens]
    text = np.searchsorted(firsts, numbers, side="right") - 1
    return chars, ends, text, numbers - firsts[text]


def word_hashes(chars: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lines (``chars`` begin at ``begins``; words are parted by single spaces), and each line's first."""
    space = chars == 32
    starts = np.zeros(len(chars), bool)
    starts[begins] = True
    starts[1:] |= space[:-1]
    starts = np.flatnonzero(starts)
    sizes = np.diff(np.append(starts, len(chars)))
    inside = np.arange(len(chars)) - np.repeat(starts, sizes)
    values = mix64(chars.astype(np.uint64) + (inside.astype(np.uint64) << np.uint64(21)) + np.uint64(1))
    values[space] = 0  # the space behind a word is not part of it
    return mix64(np.add.reduceat(values, starts)), np.searchsorted(starts, begins)


def simhashes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of every line: bit b is set where most word hashes have it. ``first`` is each line's first word.

    Bits k, 8 + k, ... 56 + k of a hash are eight bytes of (hash >> k) & 0x01..01, so that eight sums count
    all bits over up to 255 words; a longer line has several such parts.
    """
    counts = np.diff(np.append(first, len(words)))
    parts = -(-counts // 255)
    line = np.repeat(np.arange(len(first)), parts)
    number = np.arange(len(line)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = first[line] + 255 * number
    bits = np.empty((len(first), 8, 8), bool)  # line, byte, bit
    for k in range(8):
        sums = np.add.reduceat(words >> np.uint64(k) & np.uint64(0x0101010101010101), starts)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), np.cumsum(parts) - parts, axis=0)
        bits[:, :, k] = 2 * ones > counts[:, None]
    return np.packbits(bits, axis=2, bitorder="little").reshape(-1, 8).view(np.uint64).ravel()


def _grams(chars: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` characters (4 or 8) from each place on, as far as there are so many."""
    def joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
        n = min(len(a), len(b) - shift)
        return mix64(a[:n] * np.uint64(0x9E3779B97F4A7C15) + b[shift : shift + n])

    one = mix64(chars.astype(np.uint64) + np.uint64(1))
    two = joined(one, one, 1)
    four = joined(two, two, 2)
    return four if size == 4 else joined(four, four, 4)


def _signatures(chars: np.ndarray, begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """[line, hash function]: the least of the universal hashes (odd factor, mod 2**64) of each line's grams.

    Every line has at least ``size`` characters.
    """
    count = BANDS * ROWS
    factors = mix64(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)
    grams = _grams(chars, size)
    out = np.empty((count, len(begins)), np.uint64)
    start = 0
    while start < len(begins):
        # As many lines as fit the cache, one at least.
        stop = max(start + 1, int(np.searchsorted(ends, begins[start] + _VALUES, side="right")))
        low, high = begins[start], ends[stop - 1] - size + 1
        values = grams[low:high]
        # Every other segment is what lies between the grams of two lines.
        cuts = np.stack([begins[start:stop], ends[start:stop] - size + 1], axis=1).ravel()[:-1] - low
        hashed = np.empty_like(values)
        for k in range(count):
            np.multiply(values, factors[k], out=hashed)
            out[k, start:stop] = np.minimum.reduceat(hashed, cuts)[::2]
        start = stop
    return out.T


def pair_bits(chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """[line, byte]: bits of the pairs of neighbouring characters of lines (``chars`` begin at ``begins``).

    A pair's first, second, ... occurrence in its line each turn one bit over. So two lines differ in no more bits than
    one has pairs that the other has not, repeats counted; what shares a bit only hides a difference.
    """
    line = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(chars)))
    inside = np.flatnonzero(line[1:] == line[:-1])
    pairs = mix64((chars[inside].astype(np.uint64) << np.uint64(21)) + chars[inside + 1])
    found = np.sort((line[inside].astype(np.uint64) << np.uint64(32)) + (pairs >> np.uint64(32)))
    at = np.arange(len(found))
    opens = np.diff(found, prepend=np.uint64(2**64 - 1)) != 0
    number = at - np.maximum.accumulate(np.where(opens, at, 0))
    line = (found >> np.uint64(32)).astype(np.int64)
    chosen = mix64((found & np.uint64(2**32 - 1)) + (number.astype(np.uint64) << np.uint64(32))) >> np.uint64(32)
    bits = 8 * BANDS * ROWS
    turned = np.bincount(line * bits + (chosen * np.uint64(bits) >> np.uint64(32)).astype(np.int64), minlength=bits * len(begins))
    return np.packbits((turned % 2).astype(np.uint8).reshape(-1, bits), axis=1)


def _block_keys(table: np.ndarray, name: int, rows: int = ROWS) -> np.ndarray:
    """[line, block]: one key for the values of each block of ``rows`` columns."""
    grouped = table.reshape(len(table), table.shape[1] // rows, rows)
    key = np.broadcast_to(mix64(np.arange(1, grouped.shape[1] + 1, dtype=np.uint64) + np.uint64(name << 32)), grouped.shape[:2]).copy()
    for k in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key


def line_keys(chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of normalised lines, of which lines that are compared share one, and a byte of every hash of their signatures.

    Line i has the keys from offsets[i] to offsets[i + 1]; returns keys, offsets, and bytes [line, hash], which are
    those of the SHORT signature where a line has one.
    """
    sizes = np.diff(ends, prepend=0)
    missing = np.maximum(SHORT - sizes, 0)
    if missing.any():  # lines shorter than a gram are filled up
        at = np.arange(len(chars)) + np.repeat(np.cumsum(missing) - missing, sizes)
        filled = np.zeros(len(chars) + missing.sum(), np.uint32)
        filled[at] = chars
        chars, sizes = filled, sizes + missing
        ends = np.cumsum(sizes)
    begins = ends - sizes
    sims = simhashes(*word_hashes(chars, begins))
    blocks = np.stack([sims >> np.uint64(16 * i) & np.uint64(0xFFFF) for i in range(SIM_BLOCKS)], axis=1)
    chosen = [j for i in range(SIM_BLOCKS) for j in range(SIM_BLOCKS) if j != i]
    parts = [(np.arange(len(sizes)), _block_keys(blocks[:, chosen], 1))]
    signs = np.zeros((len(sizes), BANDS * ROWS), np.uint8)
    for size, wanted in ((LONG, 100 * sizes >= SIMILARITY * EDGE), (SHORT, has_short(sizes))):
        if not wanted.any():
            continue
        rows = np.flatnonzero(wanted)
        own_ends = np.cumsum(sizes[rows])
        found = _signatures(chars[np.repeat(wanted, sizes)], own_ends - sizes[rows], own_ends, size)
        signs[rows] = (found >> np.uint64(_BYTE)).astype(np.uint8)
        parts.append((rows, _block_keys(found, size + 1)))
        if size == SHORT:
            tiny = SIMILARITY * sizes[rows] < 100 * TINY
            parts.append((rows[tiny], _block_keys(found[tiny], 0, TINY_ROWS)))
    many = np.zeros(len(sizes) + 1, np.int64)
    for rows, keys in parts:
        many[rows + 1] += keys.shape[1]
    offsets = np.cumsum(many)
    out, free = np.empty(offsets[-1], np.uint64), offsets[:-1].copy()
    for rows, keys in parts:
        out[free[rows][:, None] + np.arange(keys.shape[1])] = keys
        free[rows] += keys.shape[1]
    return out.view(np.int64), offsets, signs


def has_short(n_chars):
    """Whether lines of this length have a SHORT signature; that is for numbers and columns alike."""
    return SIMILARITY * n_chars < 100 * EDGE


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A text in pieces of whole lines, of about a batch each, with the number of lines before each piece."""
    begin, lines = 0, 0
    while len(text) - begin > _BATCH_BYTES and (end := text.find("\n", begin + _BATCH_BYTES)) >= 0:
        piece = text[begin:end]
        yield lines, piece
        begin, lines = end + 1, lines + piece.count("\n") + 1
    yield lines, text[begin:]


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "place", "class_a", "class_b", "n_chars", "s0", "s1", "s2", "keys"]

    def found(documents: list[tuple], texts: list[str], before: int) -> pa.RecordBatch:
        chars, ends, text, place = normal_lines(texts)
        keys, offsets, signs = line_keys(chars, ends) if len(ends) else (np.empty(0, np.int64), [0], np.empty((0, 24), np.uint8))
        sizes = np.diff(ends, prepend=0)
        short = has_short(sizes)
        signs[short] = pair_bits(chars[np.repeat(short, sizes)], np.cumsum(sizes[short]) - sizes[short])
        data = memoryview(chars.tobytes())
        cuts = [0, *(4 * ends).tolist()]
        digests = np.frombuffer(b"".join(xxh3_128_digest(data[a:b]) for a, b in zip(cuts, cuts[1:])), "<i8").reshape(-1, 2)
        doc_ids, hashes = (pa.array(c, pa.int64()).take(pa.array(text)) for c in zip(*documents))
        columns = [doc_ids, hashes, (place + before).astype(np.int32), digests[:, 0], digests[:, 1], sizes.astype(np.int32)]
        columns += [np.ascontiguousarray(c) for c in signs.view(np.int64).T]
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys))
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), listed], names=names)

    for whole in batches:
        for batch in row_slices(whole, 2, _BATCH_BYTES):
            documents = list(zip(*(batch.column(i).to_pylist() for i in range(2))))
            texts = batch.column(2).to_pylist()
            if len(texts) > 1:
                yield found(documents, texts, 0)
            else:
                for before, piece in _pieces(texts[0]) if texts else ():
                    yield found(documents, [piece], before)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: its document, place, class and keys.

    Equal normalised lines are one class, named by 128 bits of a hash.
    """
    ship(docs.sparkSession)
    text = text_or_empty()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return narrow.mapInArrow(_line_batches, _LINES)


# --- edit similarity, inside tasks -------------------------------------------
def edits_within(x: str, y: str, most: int) -> bool:
    """Whether ``most`` edits of single characters turn ``x`` into ``y``.

    A column of the table of edit distances is held as bits of two numbers (where it goes up and
    where down), so that a character of ``y`` costs a few operations on numbers of as many bits as ``x`` has characters.
    """
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > most:
        return False
    if not x:
        return True
    masks: dict[str, int] = {}
    bit = 1
    for c in x:
        masks[c] = masks.get(c, 0) | bit
        bit <<= 1
    full, top = bit - 1, bit >> 1
    up, down, score, left = full, 0, len(x), len(y)
    for c in y:
        same = masks.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        same |= down
        plus, minus = down | ~(across | up) & full, up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        left -= 1
        if score - left > most:
            return False
        plus = plus << 1 | 1
        up, down = (minus << 1 | ~(same | plus)) & full, plus & same & full
    return score <= most


def similar(x: str, y: str) -> bool:
    """Whether the edit similarity of two normalised lines is high enough.

    Replacing word by word in place bounds the edits from above; where that is little enough, nothing else is
    needed. Else the words that both begin and end with are left out, which changes no edit distance.
    """
    most = (100 - SIMILARITY) * max(len(x), len(y)) // 100
    a, b = x.split(" "), y.split(" ")
    differ = [i for i, (v, w) in enumerate(zip(a, b)) if v != w]
    if len(a) == len(b) and sum(max(len(a[i]), len(b[i])) for i in differ) <= most:
        return True
    begin = min(differ[0] if differ else len(a), len(a) - 1, len(b) - 1)
    end, shorter = 0, min(len(a), len(b)) - 1 - begin
    while end < shorter and a[-1 - end] == b[-1 - end]:
        end += 1
    return edits_within(" ".join(a[begin : len(a) - end]), " ".join(b[begin : len(b) - end]), most)


def far_apart(xs: list[str], ys: list[str]) -> np.ndarray:
    """Of every two lines, whether their pairs of neighbouring characters differ too much for the edit similarity.

    An edit takes at most two such pairs away and brings two. Pairs are counted in bins, and what shares a bin only
    hides a difference: no similar lines are far apart.
    """
    counts, longer = [], np.zeros(len(xs), np.int64)
    for texts in (xs, ys):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        longer = np.maximum(longer, sizes)
        codes = np.frombuffer(("".join(texts) + " ").encode("utf-32-le"), "<u4")[:-1]
        line = np.repeat(np.arange(len(texts)), sizes)
        inside = line[1:] == line[:-1]
        bins = (codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]) * np.uint32(0x85EBCA6B) >> np.uint32(24)
        counts.append(np.bincount((line[:-1] * 256 + bins)[inside], minlength=256 * len(texts)))
    differ = np.abs(counts[0] - counts[1]).reshape(-1, 256).sum(axis=1)
    return differ > 4 * ((100 - SIMILARITY) * longer // 100)


def _similar_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        alike = []
        for at in range(0, batch.num_rows, _PAIRS):
            xs, ys = (batch.column(i).slice(at, _PAIRS).to_pylist() for i in (2, 3))
            alike += [not far and similar(x, y) for x, y, far in zip(xs, ys, far_apart(xs, ys).tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))


# --- links ------------------------------------------------------------------
_SIDE = ["class", "n_chars", "s0", "s1", "s2"]


def _side(name: str) -> Column:
    """The columns of one side of a pair, as a struct."""
    return F.struct(*_SIDE).alias(name)


def _alike(a: str, b: str) -> Column:
    """Whether lengths and signatures of two classes allow the similarity. A short line's signature and a long one's say nothing together.

    Short lines that are similar always pass: an edit takes at most two pairs of neighbouring characters away and brings two.
    """
    longer = F.greatest(f"{a}.n_chars", f"{b}.n_chars")
    near = 100 * F.least(f"{a}.n_chars", f"{b}.n_chars") >= SIMILARITY * longer
    pairs, hashes = F.lit(0), F.lit(0)
    for s in _SIDE[2:]:
        bits = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        pairs = pairs + F.bit_count(bits)
        for shift in (4, 2, 1):  # any set bit of a byte reaches its lowest
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        hashes = hashes + F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))
    short = has_short(F.col(f"{a}.n_chars")), has_short(F.col(f"{b}.n_chars"))
    by_pairs = pairs <= 4 * F.floor((100 - SIMILARITY) * longer / 100)
    by_hashes = BANDS * ROWS - hashes >= AGREE
    return near & F.when(short[0] & short[1], by_pairs).otherwise(short[0] | short[1] | by_hashes)


class _Links:
    """Verified links between classes that share a key."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        keyed = classes.select(*_SIDE, F.explode("keys").alias("key"))
        counted = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
        # Keys of one class, nearly all of them, are held back before the join.
        self.members = written(maybe_among(keyed, F.col("key"), counted, F.col("key")).join(counted, "key"))
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None
        self.norms: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Adds the links among ``pairs`` of sides x and y that were not tried before."""
        ordered = [F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")]
        pairs = pairs.where(_alike("x", "y")).select(*ordered).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = written(pairs)
        wanted = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
        if self.norms is not None:
            wanted = wanted.join(self.norms.select("class"), "class", "left_anti")
        norms = _norms(self.docs, self.classes.join(wanted, "class"))
        self.norms = norms if self.norms is None else self.norms.union(norms)
        sides = pairs.join(self.norms.select(F.col("class").alias("a"), F.col("norm").alias("x")), "a")
        sides = sides.join(self.norms.select(F.col("class").alias("b"), F.col("norm").alias("y")), "b")
        found = written(sides.select("a", "b", "x", "y").mapInArrow(_similar_batches, "a long, b long"))
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        self.links = found if self.links is None else self.links.union(found)

    def open_members(self) -> DataFrame:
        """Members of keys whose classes are in different components, with their component."""
        parts = connected_components(self.links)
        placed = self.members.join(parts, F.col("class") == F.col("node"), "left")
        placed = written(placed.select("key", "members", *_SIDE, F.coalesce("component", "class").alias("part")))
        split = placed.groupBy("key").agg((F.min("part") < F.max("part")).alias("open"))
        return written(placed.join(split.where("open").select("key"), "key"))


def _across(members: DataFrame) -> DataFrame:
    """All pairs of a key that are in different components.

    A key's members are dealt into blocks of about SALT, and each goes to every block once: so a key of any size is
    spread over tasks, and no key is joined with itself as a whole.
    """
    blocks = F.expr(f"(members + {SALT - 1}) div {SALT}")
    left = members.select("key", F.pmod(F.xxhash64("class"), blocks).alias("block"), _side("x"), "part")
    right = members.select("key", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), _side("y"), F.col("part").alias("other"))
    return left.join(right, ["key", "block"]).where("x.class < y.class and part <> other").select("x", "y")


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that join every two candidates of enough similarity in one component.

    The members of a key are compared with its least class first; then all that are still in different
    components with each other.
    """
    found = _Links(docs, classes)
    hubs = found.members.groupBy("key").agg(F.min(_side("y")).alias("y"))
    found.verify(found.members.join(written(hubs), "key").where("class <> y.class").select(_side("x"), "y"))
    found.verify(_across(found.open_members()))
    return found.links


def _norms(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, norm): the normalised text of ``classes``, read again from the documents that hold their first lines."""
    firsts = written(classes.select("class", "first.*"))
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    texts = maybe_among(texts, F.col("_hash"), firsts, F.col("text_hash"))
    placed = texts.select("_doc", "_hash", F.posexplode(F.split("_text", "\n")).alias("_place", "_line"))
    # Only lines that are wanted are shuffled, not the documents around them.
    placed = maybe_among(placed, F.xxhash64("_hash", "_place"), firsts, F.xxhash64("text_hash", "place"))
    at = F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")) & (F.col("_place") == F.col("place"))
    return written(firsts.join(placed, at).select("class", normalised(F.col("_line")).alias("norm")).dropDuplicates(["class"]))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, places): the lines of a document that an earlier line of the corpus stands for."""
    lines = written(_lines(docs))
    first = F.min(F.struct("doc_id", "text_hash", "place")).alias("first")
    same = [F.any_value(c).alias(c) for c in (*_SIDE[1:], "keys")]
    classes = lines.groupBy("class_a", "class_b").agg(first, F.count(F.lit(1)).alias("n"), *same)
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()))
    parts = written(connected_components(_links(docs, classes)))
    grouped = classes.join(parts, F.col("class") == F.col("node"))
    first_of = grouped.groupBy("component").agg(F.min("first").alias("kept"))
    linked = grouped.join(first_of, "component").select("class_a", "class_b", "kept")
    copied = classes.where("n > 1").join(parts, F.col("class") == F.col("node"), "left_anti")
    judged = written(linked.union(copied.select("class_a", "class_b", F.col("first").alias("kept"))))
    extra = lines.join(judged, ["class_a", "class_b"]).where(F.struct("doc_id", "text_hash", "place") != F.col("kept"))
    return extra.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))


def _left_of(texts: pd.Series, places: pd.Series) -> pd.Series:
    """Texts without the lines at ``places``, in one pass over each."""
    out = []
    for text, dropped in zip(texts, places):
        if dropped is not None:
            gone = set(dropped.tolist())
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        out.append(text)
    return pd.Series(out, dtype=object)


def _cleaned(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``_row``, with its doc_id, cleaned text and counts of lines."""
    with scratch() as keep:
        gone = keep(written(repeated_lines(docs)))
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    text = F.col("text").cast("string")
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), old=text, text_hash=F.xxhash64(text_or_empty()))
    # Texts that surely lose no line stay out of the shuffle and of Python.
    apart = maybe_among(rows, F.col("text_hash"), gone, F.col("_hash"), False).select("*", F.col("old").alias("text"))
    rows = maybe_among(rows, F.col("text_hash"), gone, F.col("_hash"))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    rows = rows.withColumn("text", F.pandas_udf(_left_of, "string")("old", "places"))
    rows = rows.unionByName(apart, allowMissingColumns=True)
    return rows.select(
        "doc_id",
        "text",
        F.coalesce(F.size(F.split("old", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("places").isNotNull(), F.size("places")), F.lit(0)).cast("long").alias("n_dropped"),
        "_row",
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, cleaned text, n_lines before and n_dropped for every row of ``docs``; see dedup_lines."""
    return _cleaned(docs).drop("_row")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines taken out of ``text`` that an earlier line already says.

    Lines are compared in normal form. Equal ones are one class. Classes that share a key (see
    ``line_keys``) are linked where the edit similarity is 0.85 or more. Of every connected group the first line
    (by doc_id, then text hash and place) stays; blank lines stay.

    NULL texts stay NULL and have no line. Rows equal in doc_id and text are one
    document listed more than once: they keep the same lines. A document that
    loses all lines keeps an empty text. All other columns stay as they were.
    """
    cleaned = _cleaned(docs)
    return cleaned.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])

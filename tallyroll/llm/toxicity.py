"""Toxic spans by a linear-chain conditional random field, and scores of documents from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import row_slices, ship, text_or_empty

FOLDS = 5
# The model is fitted on at most SAMPLE rows labelled 1 and twice as many labelled 0, none longer than LONGEST
# characters. Near copies of a row already taken would count its words again and again, so they are passed over.
SAMPLE, LONGEST = 1500, 20_000
COPY_SHINGLES, COPY_SHARED = 32, 4
FEATURE_BITS = 18
PREFIXES, SUFFIX = (3, 4, 5), 3
# A token of a toxic row is labelled toxic when it, or its beginning, is in this many of them at least,
# and at this many times the rate of other rows.
LEAST_ROWS, LEAST_RATIO = 5, 20.0
EPOCHS, BATCH, RATE, DECAY = 5, 200, 0.1, 1e-5
# Marginals below FAINT don't count; of the others, a sum of EVIDENCE makes a score of one half.
FAINT, EVIDENCE = 0.05, 0.97
_BATCH_BYTES = 4 << 20
_KNOWN_WORDS = 200_000

TOKEN = re.compile(r"[^\W\d_]+")
_RESULT = "doc_id long, score double, spans array<struct<start: int, end: int>>"


def features(word: str) -> list[int]:
    """Hashed features of one token: a constant, itself, its beginnings and its ending."""
    word = word.lower()
    named = ["=" + word, *(f"{n}{word[:n]}" for n in PREFIXES), "$" + word[-SUFFIX:]]
    return [0, *(1 + crc32(n.encode()) % (2**FEATURE_BITS - 1) for n in named)]


def chains(potentials: list[np.ndarray], transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many two-state chains at once.

    ``potentials`` holds, per chain, the log-odds that its tokens give to state
    1; ``transitions[i, j]`` scores state j after i. Returns the marginals of state
    1, chain after chain, the expected counts of the four transitions, and the
    place at which each chain begins. Chains run side by side, longest first, so
    that step t works on those that are longer than t.
    """
    lengths = np.array([len(p) for p in potentials], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    order = np.argsort(-lengths, kind="stable")
    ordered, starts = lengths[order], begins[:-1][order]
    flat = np.exp(np.clip(np.concatenate(potentials) if potentials else np.empty(0), -30, 30))
    t = np.exp(transitions)
    steps = int(ordered[0]) if len(ordered) else 0
    active = np.searchsorted(-ordered, -np.arange(steps), side="left")  # chains longer than each step
    ahead, back = np.empty(len(flat)), np.empty(len(flat))
    for s in range(steps):
        at = starts[: active[s]] + s
        if s == 0:
            one, zero = flat[at], np.ones(len(at))
        else:
            p = one[: active[s]] if len(one) > active[s] else one
            zero = (1 - p) * t[0, 0] + p * t[1, 0]
            one = ((1 - p) * t[0, 1] + p * t[1, 1]) * flat[at]
        one = one / (one + zero)
        ahead[at] = one
    expected = np.zeros((2, 2))
    right = np.empty(0)
    for s in reversed(range(steps)):
        n, m = int(active[s]), len(right)
        now = np.full(n, 0.5)
        if m:
            at = starts[:m] + s
            after = flat[at + 1] * right
            rest = 1 - right
            to = np.array([[t[0, 0] * rest, t[0, 1] * after], [t[1, 0] * rest, t[1, 1] * after]])
            p = ahead[at]
            both = to * np.array([1 - p, p])[:, None, :]
            expected += (both / both.sum(axis=(0, 1))).sum(axis=2)
            sums = to.sum(axis=1)
            now[:m] = sums[1] / (sums[0] + sums[1])
        right = now
        back[starts[:n] + s] = right
    joint = ahead * back
    return joint / (joint + (1 - ahead) * (1 - back)), expected, begins


def label_tokens(texts: list[list[str]], toxic: list[int]) -> list[np.ndarray]:
    """Token labels from row labels: tokens that rows labelled toxic have far more often than others."""
    seen = (Counter(), Counter())
    for words, y in zip(texts, toxic):
        seen[y].update({part for w in set(words) for part in (w, w[:4] + "*", w[:5] + "*")})
    rows = [max(1, toxic.count(0)), max(1, toxic.count(1))]

    def marked(part: str) -> bool:
        n = seen[1][part]
        return n >= LEAST_ROWS and n / rows[1] >= LEAST_RATIO * (seen[0][part] + 0.5) / rows[0]

    known: dict[str, bool] = {}
    out = []
    for words, y in zip(texts, toxic):
        if y:
            for w in set(words) - known.keys():
                known[w] = any(marked(p) for p in (w, w[:4] + "*", w[:5] + "*"))
        out.append(np.array([bool(y) and known[w] for w in words], float))
    return out


def without_copies(texts: list[str]) -> list[int]:
    """Which texts to take so that no two share much: places in ``texts``.

    A text is passed over when several of its least 3-word shingle hashes were
    among those of texts taken before.
    """
    seen: set[int] = set()
    taken = []
    for i, text in enumerate(texts):
        words = [w.lower() for w in TOKEN.findall(text)]
        least = sorted({crc32(" ".join(words[k : k + 3]).encode()) for k in range(len(words) - 2)})[:COPY_SHINGLES]
        if sum(h in seen for h in least) < COPY_SHARED:
            seen.update(least)
            taken.append(i)
    return taken


class TaggerModel:
    """Weights of the field: one per hashed feature, and the four transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions

    @classmethod
    def fit(cls, rows: list[tuple[str, int]]) -> TaggerModel:
        """Maximum likelihood of the token labels, by Adam over batches of rows."""
        texts = [[w.lower() for w in TOKEN.findall(t)] for t, _ in rows]
        toxic = [int(y) for _, y in rows]
        labels = label_tokens(texts, toxic)
        by_word = {w: features(w) for w in {w for words in texts for w in words}}
        ids = [np.array([by_word[w] for w in words], np.int32) for words in texts]
        size = 2**FEATURE_BITS
        params = np.zeros(size + 4)
        first, second = np.zeros_like(params), np.zeros_like(params)
        rng = np.random.default_rng(0)
        filled = [i for i, words in enumerate(texts) if words]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(filled)
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                found = np.concatenate([ids[i] for i in chosen])
                wanted = np.concatenate([labels[i] for i in chosen])
                unary = params[found].sum(axis=1)
                cuts = np.cumsum([len(ids[i]) for i in chosen])[:-1]
                marginals, expected, _ = chains(np.split(unary, cuts), params[size:].reshape(2, 2))
                observed = np.zeros((2, 2))
                for i in chosen:
                    y = labels[i].astype(int)
                    np.add.at(observed, (y[:-1], y[1:]), 1)
                error = np.repeat(marginals - wanted, found.shape[1])
                gradient = np.concatenate(
                    [np.bincount(found.ravel(), weights=error, minlength=size), (expected - observed).ravel()]
                )
                gradient = gradient / len(chosen) + DECAY * params
                step += 1
                first = 0.9 * first + 0.1 * gradient
                second = 0.99 * second + 0.01 * gradient**2
                params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return cls(params[:size].astype(np.float32), params[size:].reshape(2, 2))


class _WordScores(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = self[word] = float(self.weights[features(word)].sum())
        return value


def _score_batches(batches: Iterator[pa.RecordBatch], weights: np.ndarray, transitions: np.ndarray) -> Iterator[pa.RecordBatch]:
    known = _WordScores(weights)
    for whole in batches:
        for batch in row_slices(whole, 1, _BATCH_BYTES):
            if len(known) > _KNOWN_WORDS:
                known.clear()
            texts = batch.column(1).to_pylist()
            potentials = []
            for text in texts:
                words = TOKEN.findall(text)
                potentials.append(np.fromiter(map(known.__getitem__, words), np.float64, len(words)))
            marginals, _, begins = chains(potentials, transitions)
            scores, spans = [], []
            for i, text in enumerate(texts):
                p = marginals[begins[i] : begins[i + 1]]
                toxic = float(p[p >= FAINT].sum())
                scores.append(toxic / (toxic + EVIDENCE))
                hits = p >= 0.5
                spans.append(_merged(text, hits) if hits.any() else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["doc_id", "score", "spans"],
            )


def _merged(text: str, hits: np.ndarray) -> list[dict]:
    """Character ranges of runs of toxic tokens."""
    out: list[dict] = []
    before = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if hits[i]:
            if i == before + 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            before = i
    return out


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """At most ``sample`` texts labelled 1 and twice as many labelled 0, in the order of a hash of their ids.

    Never held-out rows. Half as many texts again are gathered, since some are near copies.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    ids = usable.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    found = []
    for y, most in ((0, 2 * sample), (1, sample)):
        # More ids than wanted, since some texts are copies, too long or missing.
        chosen = ids.where(F.col("_toxic") == y).distinct().orderBy(F.xxhash64("_id"), "_id").limit(2 * most)
        rows = docs.join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("_id"))
        rows = rows.select("_id", F.col("text").cast("string").alias("text"), "_toxic")
        rows = rows.where(F.col("text").isNotNull() & (F.length("text") <= LONGEST)).dropDuplicates(["text"])
        texts = [r["text"] for r in rows.orderBy(F.xxhash64("_id"), "_id", "text").limit(most + most // 2).collect()]
        found += [(texts[i], y) for i in without_copies(texts)[:most]]
    return found


def score_documents(docs: DataFrame, model: TaggerModel) -> DataFrame:
    """doc_id, score, predicted and the toxic ``spans`` (character offsets) for every row of ``docs``.

    The field runs over all words of the whole text. The score is e / (e + EVIDENCE),
    where e is the expected number of toxic words, without faint marginals: about
    one sure word makes one half.
    NULL and empty texts score 0. Repeated rows are scored each.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    work = partial(_score_batches, weights=model.weights, transitions=model.transitions)
    return narrow.mapInArrow(work, _RESULT).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def tag_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on the labelled rows outside the held-out fold, and scores all documents.

    Without any usable label nothing can be learned: all scores are 0.
    """
    rows = training_rows(docs, labels)
    model = TaggerModel.fit(rows) if rows else TaggerModel(np.full(2**FEATURE_BITS, -1.0, np.float32), np.zeros((2, 2)))
    return score_documents(docs, model).withColumn("held_out", held_out())

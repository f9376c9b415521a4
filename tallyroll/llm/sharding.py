"""A reproducible shuffle into shards: a keyed permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import mix64, row_numbers, ship, text_or_empty

SHARDS = 8
SEED = 20_240_101
_ROUNDS = 6


def permute(rows: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """A bijection of 0 .. total-1, by a Feistel network with cycle walking.

    The network permutes the next power of four; values that land outside are
    sent through it again until they are inside, which keeps the bijection.
    """
    half = np.uint64(max(1, -(-max(total - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix64(np.uint64(seed & (2**64 - 1)) + np.arange(1, _ROUNDS + 1, dtype=np.uint64))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for key in keys:
            left, right = right, left ^ (mix64(right + key) & mask)
        return (left << half) | right

    out = network(rows.astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(total))
    while len(outside):
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= np.uint64(total)]
    return out.astype(np.int64)


def locate(row: int, total: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of one global row number, without looking at any data."""
    place = int(permute(np.array([row]), total, seed)[0])
    return place % shards, place // shards


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its size, checksum, global row number, shard and slot.

    The law is "rows": shards differ by one row at most, and slots are gapless.
    Rows are numbered by doc_id, then text checksum and size, so reruns agree;
    rows equal in all three are interchangeable. A NULL text has size 1 and
    checksum 0. ``carry`` names columns of ``docs`` to take along, for writing
    the shards themselves.
    """
    ship(docs.sparkSession)
    text = text_or_empty()
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"carried_{c}") for c in carry],
    )
    numbered = row_numbers(narrow, ["doc_id", "text_crc32", "size"])
    total = numbered.count()

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), total, seed))

    return (
        numbered.withColumn("_place", place("row_number"))
        .withColumn("shard", (F.col("_place") % shards).cast("int"))
        .withColumn("slot", F.expr(f"_place div {int(shards)}"))
        .drop("_place")
    )

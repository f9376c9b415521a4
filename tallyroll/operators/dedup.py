"""Keep-first deduplication and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``.

    Written as ``row_number() = 1`` so that Catalyst puts a WindowGroupLimit
    before the exchange: each map task sends at most one row per key, however
    many rows one key holds. The hash in front of the keys changes no group; it
    lets the sorts decide on eight bytes where text ids share a long prefix.
    """
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    ranked = df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_rn", F.row_number().over(window))
    return ranked.where("_rn = 1").drop("_rn", "_hash")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of their key, and rows in any repeated key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_count"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("rows_in_duplicates"),
    )


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once; NULL keys equal each other.

    The repeated keys are found by a pre-combined count and joined back as a
    semi join, whose row side the adaptive planner may split; a window count
    would bring all rows of a key into one task.
    """
    repeated = key_counts(df, keys).where("n > 1").select(*[F.col(k).alias(f"_dup_{k}") for k in keys])
    same_key = [df[k].eqNullSafe(repeated[f"_dup_{k}"]) for k in keys]
    return df.join(repeated, same_key, "left_semi")

"""Joins against a dimension. No join carries a broadcast hint: Spark broadcasts
a side only when its size, estimated or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_columns_from(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Bring ``columns`` of the dimension to every row of ``df``."""
    return df.join(dimension.select(key, *columns), key, how)


def orphan_rows(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the dimension; a NULL key counts as an orphan."""
    return df.join(dimension.select(key), key, "left_anti")


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Orphan keys with their row counts.

    Rows are counted per key before the join, so a key with a third of all
    rows reaches the join as one row.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return orphan_rows(counted, dimension, key)


def orphan_total(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: how many rows are orphans."""
    return orphan_keys(df, dimension, key).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("orphan_count")
    )

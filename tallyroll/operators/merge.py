"""Whole-table reload and keyed upsert as DataFrame results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reload_or_keep(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """``incoming`` replaces ``existing``; an empty ``incoming`` changes nothing."""
    return incoming.unionByName(existing.where(~incoming.exists()))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys; on a known key replace the columns ``incoming`` carries.

    Columns that ``incoming`` leaves out keep their old value; on inserted rows
    they take their default, or NULL. Keys of ``incoming`` must be unique: see
    ``repeated_keys``.
    """
    carried = set(incoming.columns)
    unknown = carried - set(existing.columns)
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    if not set(keys) <= carried:
        raise ValueError("incoming rows need every key column")

    if carried == set(existing.columns):
        kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
        return kept.unionByName(incoming).select(*existing.columns)

    defaults = defaults or {}
    old = existing.withColumn("_known", F.lit(True)).alias("old")
    new = incoming.withColumn("_incoming", F.lit(True)).alias("new")
    columns = []
    for name in existing.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        value = F.col(f"old.{name}")
        if name in carried:
            value = F.when(F.col("_incoming"), F.col(f"new.{name}")).otherwise(value)
        elif name in defaults:
            value = F.when(F.col("_known"), value).otherwise(defaults[name].cast(existing.schema[name].dataType))
        columns.append(value.alias(name))
    return old.join(new, list(keys), "full_outer").select(*columns)


def repeated_keys(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur twice in one batch; a keyed upsert must refuse them."""
    return incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

"""Source files as all-text DataFrames, and typed reads for profiling."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.schemas import text_schema


class MissingColumn(ValueError):
    """A source lacks a column that later steps read."""


def _csv(spark: SparkSession, multiline: bool):
    # A line with too many or too few cells fails the read instead of shifting cells.
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
    )


def _need(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumn(f"{path} has no column {', '.join(missing)}")
    return df


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] = (), multiline: bool = False) -> DataFrame:
    """Every cell as text; an empty cell is ``''`` and ``NA`` stays ``NA``.

    Names come from the header, in any order. Files stay splittable unless
    ``multiline`` says that quoted cells hold line breaks; without it such a
    file is refused as malformed.
    """
    return _need(_csv(spark, multiline).csv(path).na.fill(""), columns, path)


def read_json_text(spark: SparkSession, path: str, columns: Sequence[str] = (), json_lines: bool = False) -> DataFrame:
    """Flat JSON objects, every value as its text; JSON null is NULL.

    With ``columns`` the file is parsed once and other keys are skipped; without,
    a first pass finds the keys. A JSON array cannot be split, so large inputs
    come as many files or as JSON lines.
    """
    reader = spark.read.option("multiLine", not json_lines).option("mode", "FAILFAST")
    if columns:
        return reader.schema(text_schema(columns)).json(path)
    return reader.option("primitivesAsString", True).json(path)


def read_csv_typed(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with inferred types and NULL for empty cells, for profiling."""
    return _csv(spark, multiline).option("inferSchema", True).csv(path)


def read_json_typed(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """JSON with inferred types, for profiling."""
    return spark.read.option("multiLine", not json_lines).option("mode", "FAILFAST").json(path)


def with_audit(df: DataFrame, source_file: str, ingested_at: datetime | None = None) -> DataFrame:
    """Stamp every row with one UTC time, as ISO text, and the name of its source."""
    stamp = (ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)).isoformat()
    return df.withColumns({"_raw_ingested_at": F.lit(stamp), "_source_file": F.lit(source_file)})

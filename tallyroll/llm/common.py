"""Helpers shared by the operators: written intermediates, global row numbers, running totals, word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroll.session import new_folder

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_ROW_BITS = 33  # monotonically_increasing_id keeps the row in these bits, the partition above


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, wherever they run; once per context."""
    context = spark.sparkContext
    if getattr(context, "_tallyroll_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallyroll-code-")) / "tallyroll.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallyroll_shipped = True


_SCOPES: list[list[DataFrame]] = []  # what each open ``scratch`` has written so far


def written(df: DataFrame) -> DataFrame:
    """``df`` computed now into the shared folder, and read back by column.

    Cuts the lineage without holding data on any executor; the folder goes with the ``scratch`` it was written
    in, else when the application ends.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    result._written_path = path
    if _SCOPES:
        _SCOPES[-1].append(result)
    return result


def drop_written(df: DataFrame) -> None:
    """Deletes what ``written`` gave, once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end all that was written inside, but what is given to the function that it yields.

    What is kept belongs to the scratch around it, if there is one. Results that leave it must read nothing else.
    """
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _SCOPES.append([])
    try:
        yield keep
    finally:
        own = _SCOPES.pop()
        for df in own:
            if any(df is k for k in kept):
                if _SCOPES:
                    _SCOPES[-1].append(df)
            else:
                drop_written(df)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` and the whole row as ``_row``, so that no name of the row can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(*[column.alias(name) for name, column in columns.items()], row.alias("_row"))


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Rows numbered from 0 in ``order``, over all partitions.

    Rows are range-sorted and written with their place inside their partition.
    Only one count per partition is gathered to find where each one begins.
    ``order`` should tell rows apart; rows equal in it are interchangeable.
    """
    placed = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    # One row per written partition: its size is the number of range partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(begins), "_part")
        .withColumn(name, F.col("_begin") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_part", "_begin", "_place")
    )


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str | Sequence[str], name: str | Sequence[str]
) -> DataFrame:
    """Sum of ``value`` up to and including each row, within ``by`` (never NULL), in ``order``; of several values at once.

    Rows are range-partitioned, so a group of any size is spread over partitions;
    a partition needs only the sums of the partitions before it.
    """
    values, names = ([value], [name]) if isinstance(value, str) else (value, name)
    placed = written(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy(*by, "_part").agg(*[F.sum(v).alias(f"_sum{k}") for k, v in enumerate(values)])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.coalesce(F.sum(f"_sum{k}").over(earlier), F.lit(0)).alias(f"_before{k}") for k in range(len(values))]
    before = sums.select(*by, "_part", *totals)
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumns({f"_within{k}": F.sum(v).over(inside) for k, v in enumerate(values)})
    return (
        within.join(before, [*by, "_part"])
        .withColumns({n: F.col(f"_before{k}") + F.col(f"_within{k}") for k, n in enumerate(names)})
        .drop("_part", *[f"{c}{k}" for c in ("_before", "_within") for k in range(len(values))])
    )


_MAP_BITS = 22  # 65,536 words of 64 bits at most


def maybe_among(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, maybe: bool = True) -> DataFrame:
    """Rows of ``df`` whose key may occur in ``wanted``: all that do, and few others. Without ``maybe``: all other rows.

    The keys of ``wanted`` set bits of a map of fixed size, half a megabyte, which
    is broadcast. It keeps wide rows out of the shuffle of an exact join that
    follows. The more keys there are, the less it holds back; it never loses a row.
    """
    def place(k: Column) -> Column:
        return F.xxhash64(k).bitwiseAND(F.lit((1 << _MAP_BITS) - 1))

    bits = wanted.select(place(wanted_key).alias("_at")).groupBy((F.expr("_at div 64")).alias("_word"))
    table = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 as int))")).alias("_bits"))
    marked = df.withColumn("_at", place(key)).withColumn("_word", F.expr("_at div 64"))
    hit = F.expr("coalesce(shiftrightunsigned(_bits, cast(_at % 64 as int)) & 1L, 0L)") == int(maybe)
    return marked.join(F.broadcast(table), "_word", "left").where(hit).select(*[F.col(f"`{c}`") for c in df.columns])


# --- inside tasks -----------------------------------------------------------
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def row_slices(batch: pa.RecordBatch, column: int, most_bytes: int):
    """Cuts a batch so that a slice holds about ``most_bytes`` of one column; a longer value stays alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)

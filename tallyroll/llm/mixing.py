"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import WORD, packed, running_totals, text_or_empty, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # times that one document is taken
SEED = 7

_IDENTITY = ["doc_id", "source", "text_hash", "size"]


def _sources(narrow: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """One row per source: its place in code-point order (NULL last), size and target.

    Targets share ``share`` of all words by weight, none above ``most`` times its
    source. With sources in the order in which they reach that limit, the words
    left after those that do, over the weights of the others, is the level at
    which all others stop. The table has one row per source.
    """
    sizes = narrow.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(listed, F.col("rank") % len(weights)))
    ranked = ranked.withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    filled = ranked.withColumns(
        {"place": F.row_number().over(by_limit), "budget": budget, "level": (budget - before) / rest}
    )
    stops = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    level = F.min(stops).over(everything)["level"]
    target = F.least("limit", F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return filled.select("source", "rank", "source_size", "budget", target.alias("target"))


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """How often the mix takes each document.

    One row per distinct (doc_id, source, text): these, the text's hash, its
    size in words, ``n`` (rows of it), source_size, target and ``copies`` (0 to
    ``most``). Every source is shuffled by a checksum of doc_id, once per turn. A
    document's virtual finish time is the words of its source up to and including
    it, over the source's target. All sources together are range-sorted by that
    time and taken until the words of all targets are used up.

    Rows equal in these columns are one document: they are taken together. NULL
    texts have no words; NULL sources are one source.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
    )
    narrow = written(narrow.groupBy(*_IDENTITY).agg(F.count(F.lit(1)).alias("n")))
    sources = written(_sources(narrow, weights, share, most))
    named = sources.withColumnRenamed("source", "_source")
    items = narrow.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    items = items.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    items = items.withColumns(
        {
            "key": F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("turn").cast("string"), F.col("doc_id").cast("string"))),
            "words": F.col("n") * F.col("size"),
        }
    )
    ties = ["turn", "key", "doc_id", "text_hash", "size"]
    queued = running_totals(items, ["rank"], ties, "words", "so_far")
    queued = queued.withColumn("finish", F.coalesce(F.try_divide(F.col("so_far").cast("double"), "target"), F.lit(0.0)))
    merged = running_totals(queued, [], ["finish", "rank", *ties], "words", "used")
    taken = F.count_if(F.col("used") <= F.col("budget")).alias("copies")
    return merged.groupBy(*_IDENTITY, "n", "source_size", "target").agg(taken)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, columns unchanged."""
    plan = written(mix_plan(docs, **options).where("copies > 0"))
    wanted = plan.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "text_hash")], "copies")
    rows = packed(
        docs,
        doc_id=F.col("doc_id").cast("long"),
        source=F.col("source").cast("string"),
        text_hash=F.xxhash64(text_or_empty()),
    )
    same = F.lit(True)
    for c in ("doc_id", "source", "text_hash"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(wanted, same).select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")

"""The numbered queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm import chat, fingerprint, idfiles, lines, minhash, mixing, packing, quality, runs, sharding, tokens, toxicity, trie
from tallyroll.llm.oracle import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_source_mixing(spark, sf_dir):
    plan = mixing.mix_plan(documents(spark, sf_dir))
    rows = plan.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op2_chat_formatting(spark, sf_dir):
    """Transcripts in which a third of the turns have lost their marker, with the true role beside the one found."""
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    place = F.concat_ws(" ", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    withheld = F.col("role").isNull() | (F.crc32(place.cast("binary")) % 3 == 0)
    spoken = F.concat(F.initcap("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    text = F.when(withheld, F.coalesce("text", F.lit(""))).otherwise(spoken).alias("text")
    pieces = talk.select("conv_id", "turn", text, F.col("role").alias("true_role"), withheld.alias("withheld"))
    turns = chat.render_turns(chat.parse_transcripts(pieces))
    known = pieces.withColumn("piece_hash", F.xxhash64("text")).drop("text").dropDuplicates(["conv_id", "turn", "piece_hash"])
    known = known.withColumnsRenamed({"conv_id": "_conv", "turn": "_turn", "piece_hash": "_hash"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("piece_hash") == F.col("_hash"))
    return turns.join(known, same).select("conv_id", "turn", "n_turn", "role", "true_role", "withheld", "n_lines", "text")


@query
def op3_toxicity(spark, sf_dir):
    scored = toxicity.tag_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


@query
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query
def op5_line_dedup(spark, sf_dir):
    return lines.line_report(documents(spark, sf_dir))


@query
def op6_fingerprints(spark, sf_dir):
    return fingerprint.fingerprint_edits(documents(spark, sf_dir))


@query
def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


@query
def op8_token_counts(spark, sf_dir):
    return tokens.count_tokens(documents(spark, sf_dir))


@query
def op9_sharding(spark, sf_dir):
    placed = sharding.shard_documents(documents(spark, sf_dir))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_quality_rules(spark, sf_dir):
    judged = quality.judge(documents(spark, sf_dir))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", "distance")


@query
def op11_periodic_runs(spark, sf_dir):
    """Every tenth text is made to go on periodically first, as the contract has it."""
    found = runs.find_runs(runs.with_planted_runs(documents(spark, sf_dir)), keep_text=False)
    best = [F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", *best, exponent, "runs_sha256", "collapsed_sha256", "n_words")


@query
def op12_token_id_files(spark, sf_dir):
    return idfiles.read_ids(idfiles.write_ids(documents(spark, sf_dir)))


@query
def op13_prefix_trie(spark, sf_dir):
    """Each conversation begins with up to five turns of the first one of its hundred."""
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conv = F.col("conv_id")
    edits = talk.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    keep = F.crc32(conv.cast("string").cast("binary")) % 6
    return trie.prefix_trie(talk, edits.select(conv, (conv - conv % 100).alias("base_id"), keep.alias("keep")))

"""Chat transcripts: roles recovered by a hidden Markov model, then rendered as canonical turns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import row_numbers, ship, written

# --- fixed values -----------------------------------------------------------
ROLES = ("system", "user", "assistant")
SPEAKERS = {
    "system": ("system", "sys", "instructions", "context"),
    "user": ("user", "human", "question", "customer", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "gpt", "model", "chatbot", "answer", "agent", "a"),
}
MARKER = r"^[\s>*#\[<|]*([A-Za-z]+)[\s*\]>|]*:+[\s*]*"
OPENING, CLOSING = "<|{role}|>\n", "\n<|end|>\n"

BLOCK = 4096  # lines that one task decodes at a time
SMOOTHING = 1.0
# What is believed of a role before any line is seen, worth so many lines: its own marker, another's, none.
PRIOR, OWN, OTHER, BARE = 50.0, 0.6, 0.0005, 0.399
# What a line is seen as: its marker (4 kinds) x how it begins (3) x its length (3) x a question or not (2).
_MARKERS, _BEGINNINGS, _LENGTHS = 4, 3, 3
OBSERVATIONS = _MARKERS * _BEGINNINGS * _LENGTHS * 2
_STATES = len(ROLES)


def _speaker(line: Column) -> Column:
    """0 to 2 for a line that begins with the marker of a role, else NULL."""
    name = F.lower(F.regexp_extract(line, MARKER, 1))
    column = F.when(F.lit(False), F.lit(0))
    for i, role in enumerate(ROLES):
        column = column.when(name.isin(*SPEAKERS[role]), F.lit(i))
    return column


def transcript_lines(transcripts: DataFrame) -> DataFrame:
    """One row per line of (conv_id, turn, text): ids, place, text without marker, speaker and observation.

    A transcript may come as one text or as pieces in the order of ``turn``.
    """
    pieces = transcripts.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    pieces = pieces.distinct().withColumn("piece_hash", F.xxhash64("text"))
    lines = pieces.select("conv_id", "turn", "piece_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("speaker", _speaker(F.col("line")))
    body = F.when(F.col("speaker").isNotNull(), F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    lines = lines.withColumn("body", body)
    beginning = F.when(F.col("line_no") > 0, 2).when(F.coalesce(F.col("turn"), F.lit(0)) > 0, 1).otherwise(0)
    length = F.when(F.length("body") < 40, 0).when(F.length("body") < 200, 1).otherwise(2)
    question = F.rtrim("body").endswith("?").cast("int")
    marker = F.coalesce(F.col("speaker"), F.lit(_MARKERS - 1))
    observed = ((marker * _BEGINNINGS + beginning) * _LENGTHS + length) * 2 + question
    return lines.withColumn("observed", observed.cast("int"))


class RoleModel:
    """Log-probabilities: of the first role, of the next role (inside a piece, and at its start), of what is seen."""

    def __init__(self, first: np.ndarray, inside: np.ndarray, across: np.ndarray, emission: np.ndarray):
        self.first, self.inside, self.across, self.emission = first, inside, across, emission

    @classmethod
    def fit(cls, lines: DataFrame) -> RoleModel:
        """Counts over all marked lines; a line without a marker belongs to the speaker of its piece.

        What is gathered are counts per pair of roles and per role and
        observation, however long the table. Pieces without a marker teach
        nothing. A piece follows the one whose turn is one less.
        """
        spoken = lines.where("speaker is not null")
        pieces = written(spoken.groupBy("conv_id", "turn").agg(F.min_by("speaker", "line_no").alias("role")))
        believed = np.full((_STATES, _MARKERS), OTHER)
        np.fill_diagonal(believed, OWN)
        believed[:, -1] = BARE
        emission = np.repeat(believed * PRIOR * _MARKERS / OBSERVATIONS, OBSERVATIONS // _MARKERS, axis=1)
        owned = lines.join(pieces, ["conv_id", "turn"]).withColumn("role", F.coalesce("speaker", "role"))
        for r in owned.groupBy("role", "observed").agg(F.count(F.lit(1)).alias("n")).collect():
            emission[r["role"], r["observed"]] += r["n"]
        unmarked = emission.reshape(_STATES, _MARKERS, -1)
        # Markers are the usual but not the only sign: lines of a role also come without one.
        unmarked[:, -1] += 0.05 * unmarked[:, :-1].sum(axis=1)
        across = np.full((_STATES, _STATES), SMOOTHING)
        following = pieces.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
        for r in pieces.join(following, ["conv_id", "turn"]).groupBy("role", "next").agg(F.count(F.lit(1)).alias("n")).collect():
            across[r["role"], r["next"]] += r["n"]
        first = np.full(_STATES, SMOOTHING)
        starts = pieces.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role"))
        for r in starts.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect():
            first[r["role"]] += r["n"]
        # Inside a piece a speaker goes on unless a marker says otherwise.
        inside = across / across.sum(axis=1, keepdims=True) * 0.02 + np.eye(_STATES) * 0.98
        log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        return cls(log(first), log(inside), log(across), log(emission))


def _scores(model: RoleModel, observed: np.ndarray, begins: np.ndarray, opens: bool) -> np.ndarray:
    """Step scores [line, role before, role]: how a line's role follows the one before, with what is seen."""
    steps = np.where(begins[:, None, None], model.across, model.inside) + model.emission[:, observed].T[:, None, :]
    if opens:  # the first line of a conversation has nothing before it
        steps[0] = model.first[None, :] + model.emission[:, observed[0]][None, :]
    return steps


def viterbi(steps: np.ndarray, before: int, last: int | None) -> np.ndarray:
    """The best roles, given the role before the first line and, if any, that of the last line."""
    best, links = steps[0][before], []
    for step in steps[1:]:
        ways = best[:, None] + step
        links.append(ways.argmax(axis=0))
        best = ways.max(axis=0)
    out = [int(best.argmax()) if last is None else last]
    for link in reversed(links):
        out.append(int(link[out[-1]]))
    return np.array(out[::-1], np.int64)


def best_ways(steps: np.ndarray) -> np.ndarray:
    """[role before, last role]: the best score over all roles between."""
    best = steps[0]
    for step in steps[1:]:
        best = (best[:, :, None] + step[None]).max(axis=1)
    return best


def _runs(block: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, bool]]:
    """The conversations inside a block, and whether each begins here."""
    starts = np.flatnonzero(block["opens"].to_numpy())
    cuts = sorted({0, *starts, len(block)})
    for a, b in zip(cuts, cuts[1:]):
        part = block.iloc[a:b]
        yield part, bool(part["opens"].iloc[0])


def parse_transcripts(transcripts: DataFrame) -> DataFrame:
    """Every line of ``transcripts`` (conv_id, turn, text) with the role that Viterbi gives it.

    Returns conv_id, turn, line_no, role, body (the line without its marker) and
    ``exchange``, which numbers the lines of the table so that (conv_id, exchange)
    orders them. Lines are range-sorted and cut into blocks of BLOCK lines, so that
    a conversation of any length is decoded in pieces: for the one that may go on at either end of a block,
    the block first gives the best score between every role before it and every last role, a
    conversation's blocks are joined by these few numbers, and each is then
    decoded between fixed ends; all other conversations of a block are decoded at once. The result is that of one pass over the whole.

    NULL texts are one empty line. NULL conv_ids are one conversation; NULL turns
    come first in theirs. Pieces equal in conv_id, turn and text are one piece.
    """
    ship(transcripts.sparkSession)
    lines = written(transcript_lines(transcripts))
    model = RoleModel.fit(lines)
    numbered = row_numbers(lines, ["conv_id", "turn", "piece_hash", "line_no"], "exchange")
    starts = numbered.groupBy("conv_id").agg(F.min("exchange").alias("_start"))
    opening = starts.select(F.col("_start").alias("exchange"), F.lit(True).alias("_opens"))
    numbered = numbered.join(opening, "exchange", "left").withColumns(
        {"opens": F.coalesce("_opens", F.lit(False)), "block": F.expr(f"exchange div {BLOCK}")}
    )
    numbered = written(numbered.drop("_opens"))
    narrow = numbered.select("block", "exchange", "conv_id", "line_no", "observed", "opens")

    def ends(block: pd.DataFrame) -> pd.DataFrame:
        rows, runs = [], list(_runs(block.sort_values("exchange")))
        for i, (part, opens) in enumerate(runs):
            if opens and i < len(runs) - 1:
                continue  # begins and ends here: decoded at once
            steps = _scores(model, part["observed"].to_numpy(), part["line_no"].to_numpy() == 0, opens)
            rows.append((part["exchange"].iloc[0], best_ways(steps).ravel().tolist()))
        return pd.DataFrame(rows, columns=["exchange", "ways"])

    def joined(runs: pd.DataFrame) -> pd.DataFrame:
        ordered = runs.sort_values("exchange")
        steps = np.stack([np.reshape(w, (_STATES, _STATES)) for w in ordered["ways"]])
        lasts = viterbi(steps, 0, None)
        return pd.DataFrame({"exchange": ordered["exchange"].to_numpy(), "before": [0, *lasts[:-1]], "last": lasts})

    runs = written(narrow.drop("conv_id").groupBy("block").applyInPandas(ends, "exchange long, ways array<double>"))
    named_runs = runs.join(narrow.select("exchange", "conv_id"), "exchange")
    fixed = written(named_runs.groupBy("conv_id").applyInPandas(joined, "exchange long, before int, last int"))
    marked = narrow.drop("conv_id").join(fixed, "exchange", "left")

    def decoded(block: pd.DataFrame) -> pd.DataFrame:
        ordered = block.sort_values("exchange")
        roles = []
        for part, opens in _runs(ordered):
            steps = _scores(model, part["observed"].to_numpy(), part["line_no"].to_numpy() == 0, opens)
            before, last = part["before"].iloc[0], part["last"].iloc[0]
            roles.append(viterbi(steps, 0, None) if pd.isna(last) else viterbi(steps, int(before), int(last)))
        return pd.DataFrame({"exchange": ordered["exchange"].to_numpy(), "role_id": np.concatenate(roles)})

    roles = marked.groupBy("block").applyInPandas(decoded, "exchange long, role_id int")
    named = F.get(F.array(*[F.lit(r) for r in ROLES]), F.col("role_id")).alias("role")
    return numbered.join(written(roles), "exchange").select("conv_id", "turn", "piece_hash", "line_no", "exchange", named, "body")


def render_turns(parsed: DataFrame) -> DataFrame:
    """Canonical turns of parsed pieces: conv_id, turn, piece_hash, n_turn, role, n_lines and the rendered text.

    Pieces of one conversation and turn are told apart by the hash of their text; equal ones are one.

    Lines in a row of one piece and one role are one turn; a speaker who changes
    inside a piece begins another. What is gathered is never more than a piece.
    """
    piece = ["conv_id", "turn", "piece_hash"]
    inside = Window.partitionBy(*piece).orderBy("line_no")
    changed = F.coalesce(F.col("role") != F.lag("role").over(inside), F.lit(False)).cast("int")
    numbered = parsed.withColumn("_changed", changed).withColumn("n_turn", F.sum("_changed").over(inside))
    turns = numbered.groupBy(*piece, "n_turn").agg(
        F.any_value("role").alias("role"),
        F.count(F.lit(1)).alias("n_lines"),
        F.array_sort(F.collect_list(F.struct("line_no", "body"))).alias("lines"),
    )
    body = F.trim(F.array_join(F.transform("lines", lambda x: x["body"]), "\n"))
    opening = F.format_string(OPENING.replace("{role}", "%s"), "role")
    return turns.select(*piece, "n_turn", "role", "n_lines", F.concat(opening, body, F.lit(CLOSING)).alias("text"))

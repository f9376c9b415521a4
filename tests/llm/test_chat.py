from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import chat
from tallyroll.llm.queries import QUERIES


def model():
    rng = np.random.default_rng(0)
    log = lambda *s: np.log(rng.dirichlet(np.ones(s[-1]), s[:-1]))
    return chat.RoleModel(log(3), log(3, 3), log(3, 3), log(3, chat.OBSERVATIONS))


def test_blocks_give_what_one_pass_gives():
    rng = np.random.default_rng(1)
    seen, begins = rng.integers(0, chat.OBSERVATIONS, 200), rng.random(200) < 0.3
    steps = chat._scores(model(), seen, begins, True)
    whole = chat.viterbi(steps, 0, None)
    cuts = [0, 50, 51, 120, 200]
    ways = np.stack([chat.best_ways(steps[a:b]) for a, b in zip(cuts, cuts[1:])])
    lasts = chat.viterbi(ways, 0, None)
    pieces = [chat.viterbi(steps[a:b], before, last) for a, b, before, last in zip(cuts, cuts[1:], [0, *lasts[:-1]], lasts)]
    assert np.concatenate(pieces).tolist() == whole.tolist()


def test_the_best_of_all_paths():
    """Every sequence of roles is scored; none is better than the one found, with open and with fixed ends."""
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 7):
        seen, begins = rng.integers(0, chat.OBSERVATIONS, n), rng.random(n) < 0.4
        steps = chat._scores(model(), seen, begins, True)
        score = lambda path: sum(s[a, b] for s, a, b in zip(steps, (0, *path), path))
        paths = list(product(range(3), repeat=n))
        assert score(tuple(chat.viterbi(steps, 0, None))) == pytest.approx(max(map(score, paths)))
        for last in range(3):
            wanted = max(score(p) for p in paths if p[-1] == last)
            assert score(tuple(chat.viterbi(steps, 0, last))) == pytest.approx(wanted)
            assert chat.best_ways(steps)[0, last] == pytest.approx(wanted)


def test_the_query_withholds_markers(spark, sf_dir):
    rows = QUERIES["op2_chat_formatting"](spark, sf_dir).collect()
    assert len({(r["conv_id"], r["turn"]) for r in rows}) == spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    for withheld, least in ((False, 0.99), (True, 0.8)):
        some = [r for r in rows if r["withheld"] == withheld]
        right = np.mean([r["role"] == r["true_role"] for r in some])
        print("withheld", withheld, len(some), right)
        assert len(some) > 100 and right >= least


def test_roles_are_recovered_where_markers_are_missing(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 37)
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    hidden = F.crc32(F.concat_ws("-", "conv_id", "turn").cast("binary")) % 5 == 0
    name = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "**AI**").otherwise("System")
    pieces = talk.select("conv_id", "turn", F.when(hidden, F.col("text")).otherwise(F.concat(name, F.lit(": "), "text")).alias("text"))
    turns = chat.render_turns(chat.parse_transcripts(pieces)).collect()
    truth = {(r["conv_id"], r["turn"]): r for r in talk.withColumn("hidden", hidden).collect()}
    assert {(r["conv_id"], r["turn"]) for r in turns} == truth.keys()
    shown = [r for r in turns if not truth[r["conv_id"], r["turn"]]["hidden"]]
    unseen = [r for r in turns if truth[r["conv_id"], r["turn"]]["hidden"]]
    right = lambda rows: np.mean([r["role"] == truth[r["conv_id"], r["turn"]]["role"] for r in rows])
    assert right(shown) > 0.99
    assert right(unseen) > 0.85
    for r in shown:
        t = truth[r["conv_id"], r["turn"]]
        if r["role"] == t["role"] and r["n_lines"] == t["text"].count("\n") + 1:
            assert r["text"] == f"<|{t['role']}|>\n{t['text'].strip(' ')}\n<|end|>\n"


def test_awkward_rows(spark):
    rows = [
        (1, 0, "User: hi\nhow are you?\nAssistant: fine"),
        (1, 1, None),
        (2, 0, ""),
        (None, None, "Q: what?"),
        (None, 3, "A: that"),
        (3, 0, "system: x"),
        (3, 0, "system: x"),
        (4, 0, "no marker " * 3000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    df = df.withColumns({"role": F.lit("z"), "line_no": F.lit(9), "exchange": F.lit(1), "body": F.lit("b")})
    turns = chat.render_turns(chat.parse_transcripts(df)).collect()
    got = {(r["conv_id"], r["turn"], r["n_turn"]): (r["role"], r["text"]) for r in turns}
    assert got[1, 0, 0] == ("user", "<|user|>\nhi\nhow are you?\n<|end|>\n")
    assert got[1, 0, 1] == ("assistant", "<|assistant|>\nfine\n<|end|>\n")
    assert got[None, None, 0][0] == "user" and got[None, 3, 0][0] == "assistant"
    assert len(turns) == 8
    assert chat.render_turns(chat.parse_transcripts(df.where("false"))).collect() == []

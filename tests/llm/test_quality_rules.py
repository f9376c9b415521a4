import re
from collections import Counter

import numpy as np
import pytest

from tallyroll.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(df):
    rows = df.select("doc_id", "text").collect()
    judged = quality.judge(df).collect()
    wanted = sorted(((r["doc_id"], *statistics(r["text"])) for r in rows), key=repr)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in judged), key=repr) == wanted
    assert not any(r["kept"] and r["base_failed"] for r in judged)
    return judged


def test_given_documents(documents, spark, sf_dir):
    judged = {r["doc_id"]: r for r in check(documents)}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [judged[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1]
    bad = [judged[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert np.mean(good) > 0.85
    assert np.mean(bad) < 0.25


def test_awkward_rows(awkward, no_docs):
    check(awkward)
    assert check(no_docs) == []
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns


def half_with_least_determinant(x, spreads):
    """Concentration steps in numpy, from the same start."""
    centre = np.median(x, axis=0)
    q = np.percentile(x, [25, 75], axis=0)
    factor = np.diag(np.maximum((q[1] - q[0]) / 1.349, spreads))
    for _ in range(quality.STEPS):
        d = (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)
        inside = x[d <= np.sort(d)[(len(d) - 1) // 2]]
        centre = inside.mean(axis=0)
        factor = np.linalg.cholesky(np.cov(inside.T, bias=True) + np.diag(np.array(spreads) ** 2))
    d = (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)
    return d / max(1.0, np.median(d) / quality.MEDIAN)


def test_distances_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    x[:60] += 15
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "group string, " + ", ".join(f"{n} double" for n in quality._X))
    estimates = quality.least_determinant(df)
    got = df.join(estimates, "group").select(*quality._X, (quality._distance(quality._X) / estimates["scale"]).alias("d")).toPandas()
    wanted = half_with_least_determinant(got[quality._X].to_numpy(), list(quality.SPREADS.values()))
    assert got["d"].to_numpy() == pytest.approx(wanted, rel=0.05)
    assert (got["d"] > quality.CUTOFF).sum() >= 60


@pytest.mark.parametrize("odd", ["words", "symbols", "lines", "repeats"])
def test_lone_outlier_in_one_statistic(docs_of, odd):
    """One document among 80 like each other differs in one statistic alone, within the base rules."""
    rng = np.random.default_rng(8)

    def text(n, letters=6, symbols=0, lines=0, repeats=0):
        words = ["".join(rng.choice(list("abcdefgh"), letters + rng.integers(-1, 2))) for _ in range(10 * n)]
        rows = [words[i : i + 10] for i in range(0, len(words), 10)]
        for i in range(symbols):
            rows[i][0] += "#" * 6
        if repeats:  # 3-word windows, in lines that differ otherwise
            for i in range(repeats):
                rows[i][2:8] = rows[0][2:8]
        rows = [" ".join(r) for r in rows]
        return "\n".join(rows + ["a b"] * lines)

    usual = [(i, text(20 + i % 9)) for i in range(80)]
    lone = {
        "words": dict(letters=12),
        "symbols": dict(symbols=18),
        "lines": dict(lines=12),
        "repeats": dict(repeats=14),
    }[odd]
    kept = {r["doc_id"]: r for r in quality.judge(docs_of([*usual, (99, text(20, **lone))])).collect()}
    assert not kept[99]["base_failed"]
    assert not kept[99]["kept"]
    assert sum(r["kept"] for r in kept.values()) > 60

"""Rules of quality: text statistics, base rules, and robust multivariate outliers per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import GAP, scratch, written

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated 3-word windows

# Statistics as used by the outlier test: log of the mean word length; arcsine roots of the shares of symbols,
# repeated lines and repeated words. A quartile range below the spread given here is nil: the group's whole spread is
# taken instead. The small one is added, so that there is always an inverse.
SPREADS = {"word_length": 0.01, "symbols": 0.01, "lines": 0.01, "repeats": 0.01}
DIMENSIONS = len(SPREADS)
COVERED = 0.5  # share of rows whose covariance has the least determinant
BROADCAST_GROUPS = 50_000  # of 25 numbers each: ten megabytes
STEPS = 100  # at most; they end when no group's determinant falls, usually after 5 to 20
LEAST_ROWS = 50  # fewer rows than this are estimated together with others
# Chi-square with four degrees of freedom: its 0.999 quantile and its median.
CUTOFF, MEDIAN = 18.467, 3.357

_X = [f"x_{n}" for n in SPREADS]
_P = range(DIMENSIONS)


# --- statistics of a text ---------------------------------------------------
def _repeated_words(words: str, hashes: str, pairs: str) -> list[tuple[str, Column]]:
    """Columns, one upon the other, that count words inside 3-word windows found twice or more.

    A window is its 64-bit hash. Only where a text has fewer distinct windows
    than windows are they sorted, with their places, to find which ones repeat.
    """
    windows = F.expr(
        f"if(size({words}) < 3, array(), transform(sequence(0, size({words}) - 3), "
        f"i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2])))"
    ).cast("array<bigint>")
    sorted_pairs = F.expr(
        f"if(size(array_distinct({hashes})) = size({hashes}), "
        f"cast(array() as array<struct<h: bigint, i: int>>), sort_array(transform({hashes}, (h, i) -> struct(h, i))))"
    )
    covered = F.expr(
        f"cast(size(array_distinct(flatten(transform(filter({pairs}, (p, j) -> "
        f"coalesce(p.h = get({pairs}, j - 1).h, false) or coalesce(p.h = get({pairs}, j + 1).h, false)), "
        f"p -> array(p.i, p.i + 1, p.i + 2))))) as bigint)"
    )
    return [(hashes, windows), (pairs, sorted_pairs), ("n_repeat_words", covered)]


def with_statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, lang, source and the base statistics; with ``carry`` the whole row as ``_row`` too."""
    taken = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text.alias("_text"),
        *taken,
    )
    df = df.withColumns(
        {
            "_words": F.array_remove(F.split("_text", GAP), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    for name, column in _repeated_words("_words", "_hashes", "_pairs"):
        df = df.withColumn(name, column)
    measured = df.select(
        "doc_id",
        "lang",
        "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        "n_repeat_words",
        *(["_row"] if carry else []),
    )
    return measured.withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    )


def _transformed() -> dict[str, Column]:
    def root(part: str, whole: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.col(whole))))

    columns = [
        F.log(F.col("word_chars") / F.col("n_words")),
        root("n_symbols", "word_chars"),
        root("n_dup_lines", "n_lines"),
        root("n_repeat_words", "n_words"),
    ]
    return dict(zip(_X, columns))


# --- minimum covariance determinant -----------------------------------------
def _grouped(measured: DataFrame) -> DataFrame:
    """The group in which the rows of each (language, source) are judged.

    A (language, source) pair with few rows is judged with the other small
    sources of its language, and if these are few as well, with all that remain.
    """
    sizes = measured.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(F.col("n") < LEAST_ROWS)
    by_lang = small.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("m"))
    level = F.when(F.col("n") >= LEAST_ROWS, 0).when(F.col("m") >= LEAST_ROWS, 1).otherwise(2)
    return written(
        sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
            "lang",
            "source",
            # Names of groups; a NULL part differs from every text.
            F.to_json(
                F.struct(
                    level.alias("level"),
                    F.when(level < 2, F.col("lang")).alias("lang"),
                    F.when(level < 1, F.col("source")).alias("source"),
                )
            ).alias("group"),
        )
    )


def _distance(x: list[str]) -> Column:
    """Squared Mahalanobis distance from the group's mean, by the Cholesky factor of its covariance."""
    solved: list[Column] = []
    for i in _P:
        rest = F.col(x[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    total = solved[0] * solved[0]
    for s in solved[1:]:
        total = total + s * s
    return total


def _estimates(moments: DataFrame) -> DataFrame:
    """Mean and Cholesky factor per group from counts, sums and products around a centre.

    A dimension without quartile range (say, most texts have no symbols) has at
    least the variance of the whole group, ``v``. The least variance comes on top,
    so that the covariance always has an inverse.
    """
    df = moments
    least = [s**2 for s in SPREADS.values()]
    for i in _P:
        df = df.withColumn(f"d{i}", F.col(f"s{i}") / F.col("n"))
    for i in _P:
        for j in range(i + 1):
            cov = F.col(f"s{i}{j}") / F.col("n") - F.col(f"d{i}") * F.col(f"d{j}")
            df = df.withColumn(f"c{i}{j}", F.greatest(cov, f"v{i}") + least[i] if i == j else cov)
    for i in _P:
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    volume = sum((F.log(f"l{i}{i}") for i in _P), F.lit(0.0))
    means = [(F.col(f"m{i}") + F.col(f"d{i}")).alias(f"m{i}") for i in _P]
    return df.select("group", *means, *[f"v{i}" for i in _P], *[f"l{i}{j}" for i in _P for j in range(i + 1)], F.least(volume, "before").alias("volume"), (volume < F.col("before") - 1e-6).alias("fell"))


def least_determinant(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per group: mean and Cholesky factor of the covariance of its most concentrated half, and a scale.

    Starts at medians and quartile ranges. A step measures all rows, finds the
    distance that covers half of them, and estimates anew from the rows within;
    this never raises the determinant; it ends when none falls. Quantiles come from mergeable sketches and
    moments from partial sums, so a group of any size stays spread out. ``scale``
    makes the median distance that of a chi-square where it is larger.
    """
    with scratch() as keep:
        return keep(written(_least_determinant(vectors, steps)))


def _least_determinant(vectors: DataFrame, steps: int) -> DataFrame:
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(f"q{i}") for i, x in enumerate(_X)]
    spreads = list(SPREADS.values())
    whole = [F.greatest(F.var_pop(x), F.lit(spreads[i] ** 2)).alias(f"v{i}") for i, x in enumerate(_X)]
    start = vectors.groupBy("group").agg(*quartiles, *whole)
    quartile_range = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in _P]
    now = start.select(
        "group",
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in _P],
        *[F.when(quartile_range[i] < spreads[i], F.col(f"v{i}")).otherwise(0.0).alias(f"v{i}") for i in _P],
        *[
            (
                F.when(quartile_range[i] >= spreads[i], quartile_range[i]).otherwise(F.sqrt(f"v{i}")) if i == j else F.lit(0.0)
            ).alias(f"l{i}{j}")
            for i in _P
            for j in range(i + 1)
        ],
        F.lit(float("inf")).alias("volume"),
    )
    now = written(now)
    few = now.count() <= BROADCAST_GROUPS

    def beside(df: DataFrame, table: DataFrame) -> DataFrame:
        """Rows beside their group's row: where these are few, rows stay where they are, and a group is in all tasks."""
        return df.join(F.broadcast(table) if few else table, "group")

    for _ in range(steps):
        measured = beside(vectors, now).withColumn("_d", _distance(_X))
        radius = written(
            measured.groupBy("group").agg(F.percentile_approx("_d", F.lit(COVERED), F.lit(10_000)).alias("radius"))
        )
        inside = beside(measured, radius).where(F.col("_d") <= F.col("radius"))
        off = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(_X)]
        sums = [F.sum(off[i]).alias(f"s{i}") for i in _P]
        products = [F.sum(off[i] * off[j]).alias(f"s{i}{j}") for i in _P for j in range(i + 1)]
        centres = [F.any_value(f"{c}{i}").alias(f"{c}{i}") for c in "mv" for i in _P]
        centres.append(F.any_value("volume").alias("before"))
        now = written(_estimates(inside.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *sums, *products, *centres)))
        if not now.where("fell").head(1):
            break
    else:
        raise RuntimeError(f"determinants still fell after {steps} steps")
    measured = beside(vectors, now).withColumn("_d", _distance(_X))
    median = F.percentile_approx("_d", F.lit(0.5), F.lit(10_000)) / MEDIAN
    scale = measured.groupBy("group").agg(F.greatest(F.lit(1.0), median).alias("scale"))
    return now.join(scale, "group")


def judge(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Statistics, base rule, squared robust ``distance`` and verdict ``kept`` for every row of ``docs``.

    ``docs`` has doc_id, text, lang and source; other columns matter only with
    ``carry``, which takes the whole row along as ``_row``. A row is kept if it
    passes the base rules and lies within CUTOFF of its group. NULL, empty and
    short texts fail the base rules (distance NULL). NULL languages and sources are
    values of their own. Repeated rows are judged each and count each.
    """
    measured = written(with_statistics(docs, carry))
    groups = _grouped(measured)
    vectors = measured.where("not base_failed").withColumns(_transformed()).select("lang", "source", *_X)
    placed = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "group")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    with scratch() as keep:
        vectors = written(vectors.join(placed, same).select("group", *_X))
        estimates = keep(least_determinant(vectors))
    per_pair = placed.join(estimates, "group").drop("group")
    found = measured.join(per_pair, same, "left")
    passed = {x: F.when(~F.col("base_failed"), column) for x, column in _transformed().items()}
    found = found.withColumns(passed)
    return found.withColumn("distance", _distance(_X) / F.col("scale")).select(
        *measured.columns,
        "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were."""
    return judge(docs, carry=True).where("kept").select("_row.*")

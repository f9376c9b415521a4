"""Operators against brute force, hot keys included."""

import random
from collections import Counter
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroll.functions.numbers import text_mean
from tallyroll.operators.dedup import duplicate_summary, duplicated_rows
from tallyroll.operators.distribution import describe_numbers, equal_width_histogram, exact_quantiles, in_ranges, running_total
from tallyroll.operators.lookup import orphan_keys, orphan_rows
from tallyroll.operators.merge import reload_or_keep, repeated_keys, upsert
from tallyroll.plans import mart, profiling, reports
from tallyroll.schemas import SOURCE_COLUMNS, text_schema
from tallyroll.session import written_once


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


# --- merge ------------------------------------------------------------------
def test_upsert_replaces_inserts_and_keeps(spark):
    old = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    new = spark.createDataFrame([("k2", 9), ("k3", 3)], "k string, v int")
    once = upsert(old, new, ["k"])
    assert as_dict(once) == {"k1": 1, "k2": 9, "k3": 3}
    assert as_dict(upsert(once, new, ["k"])) == {"k1": 1, "k2": 9, "k3": 3}


def test_upsert_of_some_columns(spark):
    old = spark.createDataFrame([("k1", 1, "a"), ("k2", 2, "b")], "k string, v int, w string")
    new = spark.createDataFrame([("k2", None), ("k3", 3)], "k string, v int")
    rows = {r.k: (r.v, r.w) for r in upsert(old, new, ["k"], {"w": F.lit("none")}).collect()}
    assert rows == {"k1": (1, "a"), "k2": (None, "b"), "k3": (3, "none")}
    with pytest.raises(ValueError):
        upsert(old, new.withColumn("x", F.lit(1)), ["k"])


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [r.k for r in repeated_keys(df, ["k"]).collect()] == ["a"]


def test_empty_reload_keeps_the_target(spark):
    old = spark.createDataFrame([("k1", 1)], "k string, v int")
    new = spark.createDataFrame([("k2", 2)], "k string, v int")
    assert as_dict(reload_or_keep(old, new)) == {"k2": 2}
    assert as_dict(reload_or_keep(old, new.where("false"))) == {"k1": 1}


# --- duplicates and orphans ---------------------------------------------------
def test_duplicates_with_nulls_and_a_hot_key(spark):
    keys = ["hot"] * 300 + [None, None, "x", "y", "y"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    counts = Counter(keys)
    summary = duplicate_summary(df, ["k"]).first()
    assert summary.duplicate_count == len(keys) - len(counts)
    repeated = sorted(r.i for r in duplicated_rows(df, ["k"]).collect())
    assert repeated == [i for i, k in enumerate(keys) if counts[k] > 1]
    assert summary.rows_in_duplicates == len(repeated)


def test_orphans(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",), ("c",), (None,)], "k string")
    dim = spark.createDataFrame([("b",)], "k string")
    assert Counter(r.k for r in orphan_rows(df, dim, "k").collect()) == {"a": 50, "c": 1, None: 1}
    assert as_dict(orphan_keys(df, dim, "k")) == {"a": 50, "c": 1, None: 1}


# --- distributions ------------------------------------------------------------
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_quantiles_match_linear_interpolation(spark, seed):
    rng = random.Random(seed)
    n = rng.randint(1, 400)
    values = [rng.choice([7.0, rng.uniform(-5, 5), rng.uniform(0, 1e9)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    probabilities = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = as_dict(exact_quantiles(df, "x", probabilities))
    expected = np.percentile(values, [100 * p for p in probabilities])
    assert [got[p] for p in probabilities] == pytest.approx(list(expected), rel=1e-12)


def test_running_total_over_many_ranges(spark):
    rows = [(i, i % 7) for i in range(2000)]
    random.Random(3).shuffle(rows)
    with written_once(in_ranges(spark.createDataFrame(rows, "k int, n int"), "k")) as written:
        got = as_dict(running_total(written, "k", "n", "t").select("k", "t"))
    total, expected = 0, {}
    for k, n in sorted(rows):
        total += n
        expected[k] = total
    assert got == expected


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.75, 10.0], [3.0, 3.0], list(np.round(np.random.default_rng(5).gamma(2, 30, 500), 2))])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    rows = equal_width_histogram(df, "x", 20).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r.value_count for r in rows] == list(counts)
    assert [r.lower_edge for r in rows] == pytest.approx(list(edges[:-1]))
    assert rows[-1].upper_edge == edges[-1]
    assert rows[0].overall_mean == pytest.approx(np.mean(values))


# --- mart ---------------------------------------------------------------------
DIM = "student_id string, class_id string, enrollment_status string"
ATT = "student_id string, class_id string, attendance_date date, status string"
ASM = "student_id string, class_id string, assessment_date date, score decimal(6,2)"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def build_mart(spark, dim, att, asm):
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((dim, DIM), (att, ATT), (asm, ASM))]
    return {(r.class_id, r.date): r for r in mart.class_daily_performance(*frames).collect()}


def test_mart_rules(spark):
    from decimal import Decimal as D

    rows = build_mart(
        spark,
        [("s1", "C1", "ACTIVE"), ("s2", "C1", "DROPPED"), ("s3", "C2", "DROPPED")],
        [
            ("s1", "C1", D1, "PRESENT"),
            ("s2", "C1", D1, "PRESENT"),
            ("s3", "C2", D1, "PRESENT"),
            ("s9", None, D1, "PRESENT"),
            ("s1", "C1", D3, "ABSENT"),
        ],
        [("s1", "C1", D2, D("10.00")), ("s1", "C1", D2, D("10.01")), ("s2", "C1", D3, D("80.00"))],
    )
    assert set(rows) == {("C1", D1), ("C1", D2), ("C1", D3)}  # no ACTIVE student in C2, no class for s9
    first, second, third = rows["C1", D1], rows["C1", D2], rows["C1", D3]
    assert (first.total_students, first.present_count, first.attendance_rate) == (1, 2, 2)
    assert (first.assessment_count, first.avg_score) == (0, 0)
    assert (second.students_with_attendance, second.attendance_rate, second.present_count) == (0, 0, 0)
    assert (second.students_with_assessment, second.assessment_count, second.avg_score) == (1, 2, D("10.01"))
    assert (third.absent_count, third.avg_score) == (1, 80)


def test_mart_keys_are_the_union_of_fact_keys(spark):
    rng = random.Random(11)
    classes = ["C1", "C2", "C3"]
    dim = [(f"s{i}", rng.choice(classes), rng.choice(["ACTIVE", "DROPPED"])) for i in range(8)]
    of = {s: c for s, c, _ in dim}
    days = [D1, D2, D3]
    att = [(s, of[s], d, rng.choice(["PRESENT", "ABSENT"])) for s in of for d in days if rng.random() < 0.4]
    asm = [(s, of[s], d, None) for s in of for d in days if rng.random() < 0.3]
    active = {c for _, c, status in dim if status == "ACTIVE"}
    expected = {(r[1], r[2]) for r in att + asm if r[1] in active}
    assert set(build_mart(spark, dim, att, asm)) == expected


# --- profiles and reports -------------------------------------------------------
def test_status_signatures_have_one_form(spark):
    rows = [("A", "s1", "2024-01-01", s, "t") for s in ("PRESENT", "ABSENT")]
    rows += [("A", "s2", "2024-01-01", s, "t") for s in ("ABSENT", "PRESENT")]
    rows += [("A", "s3", "2024-01-01", "PRESENT", "t")] * 5
    rows += [("A", "s4", "2024-01-01", "PRESENT", "t")]
    df = spark.createDataFrame(rows, text_schema(SOURCE_COLUMNS["attendance"]))
    assert as_dict(profiling.status_signatures(df)) == {"ABSENT+PRESENT": 2, "+".join(["PRESENT"] * 5): 1}


@pytest.mark.parametrize(
    ("score", "most", "ok"),
    [("100", "100", True), ("100.00000000001", "100", False), ("NaN", "100", False), ("abc", "100", False), ("4e-11", "5e-11", True)],
)
def test_scores_within_max_compares_as_doubles(spark, score, most, ok):
    students = spark.createDataFrame([("s1", "n", "C", "10", "ACTIVE", "t")], text_schema(SOURCE_COLUMNS["students"]))
    attendance = spark.createDataFrame([("A", "s1", "2024-01-01", "PRESENT", "t")], text_schema(SOURCE_COLUMNS["attendance"]))
    rows = [("E", "s1", "Math", score, most, "2024-01-01", "t")]
    assessments = spark.createDataFrame(rows, text_schema(SOURCE_COLUMNS["assessments"]))
    checks = profiling.readiness({"students": students, "attendance": attendance, "assessments": assessments})
    passed = {r.check: r.passed for r in checks.collect()}
    assert passed.pop("scores_within_max") is ok and all(passed.values())


def test_means_keep_small_numbers_and_skip_what_is_none(spark):
    df = spark.createDataFrame([(t,) for t in ("0.00000000004", "0.00000000004", "NaN", "abc", None)], "score string")
    assert df.agg(text_mean(F.col("score"))).first()[0] == pytest.approx(4e-11)
    described = {r.statistic: r.value for r in describe_numbers(df, "score", 12).collect()}
    assert (described["count"], described["50%"]) == (2, 4e-11)


def test_class_without_present_rows_has_rate_zero(spark):
    students = spark.createDataFrame([("s1", "C1"), ("s2", "C2")], "student_id string, class_id string")
    rows = [("A1", "s1", "2024-01-01", "PRESENT", "t"), ("A2", "s2", "2024-01-01", "ABSENT", "t")]
    df = spark.createDataFrame(rows, text_schema(SOURCE_COLUMNS["attendance"]))
    got = {r.class_id: r.avg_daily_attendance_rate for r in profiling.class_attendance(df, students).collect()}
    assert got == {"C1": 1.0, "C2": 0.0}


def test_nulls_and_previews(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    rows = {r.column_name: r for r in profiling.shape_and_nulls(df, "t").collect()}
    assert (rows["b"].null_count, rows["b"].table_nulls, rows["b"].row_count, rows["b"].column_count) == (2, 2, 3, 2)
    assert profiling.preview(df, 2).count() == 2
    assert profiling.distinct_preview(df, "b").count() == 2
    assert [tuple(r) for r in profiling.counts_by(df, "a").collect()] == [(1, 1), (2, 1), (3, 1)]


def test_pivot_can_look_up_its_columns(spark):
    students = spark.createDataFrame([("s1", "C1")], "student_id string, class_id string")
    rows = [("E1", "s1", "Art", "1.005", "9", "2024-01-01", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, text_schema(SOURCE_COLUMNS["assessments"]))
    assert profiling.subject_pivot(df, students, None).first().asDict() == {"class_id": "C1", "Art": 1.0}


def test_report_labels_order_and_limit(spark):
    df = spark.createDataFrame([("a", 1, D1), ("b", 5, D1), ("b", 7, D2)], "g string, v int, d date")
    assert reports.metric("v", "SUM").label == "SUM(v)"
    rows = reports.report(df, [reports.metric("v", "SUM"), reports.metric("v", "COUNT", "n")], ["g"], row_limit=1)
    assert [r.asDict() for r in rows.collect()] == [{"g": "b", "SUM(v)": 12, "n": 2}]
    monthly = reports.report(df, [reports.metric("v", "MAX", "top")], time_column="d", grain="P1M")
    assert [tuple(r) for r in monthly.collect()] == [(D1, 7)]
    wide = spark.range(60_000)
    assert reports.report(wide, columns=["id"]).count() == 60_000
    assert reports.report(wide, [reports.metric("id", "SUM")], ["id"]).count() == 60_000
    assert reports.report(wide, columns=["id"], row_limit=55_000).count() == 55_000


def test_limits_of_requests(spark):
    """A named limit wins over the server's, larger or smaller; without either all rows come."""
    df = spark.range(50).select(F.col("id").cast("string").alias("g"), F.lit(1).alias("n"))
    grouped = reports.Request(metrics=[reports.metric("n", "SUM")], groupby=["g"])
    server = reports.RequestSettings(default_limit=7)
    assert reports.answer(df, grouped, server).count() == 7
    assert reports.answer(df, replace(grouped, row_limit=20), server).count() == 20
    assert reports.answer(df, replace(grouped, row_limit=3), server).count() == 3
    assert reports.answer(df, grouped).count() == 50
    assert reports.answer(df, reports.Request(columns=["g"], row_limit=0), server).count() == 0
    with pytest.raises(ValueError):
        reports.RequestSettings(default_limit=0)


def test_previews_have_an_order(spark):
    df = spark.createDataFrame([(i * 7 % 50,) for i in range(50)], "id int").repartition(9)
    assert [r.id for r in profiling.preview(df, 4, ["id"]).collect()] == [0, 1, 2, 3]
    assert profiling.preview(df, 4).count() == 4
    assert [r.id for r in profiling.distinct_preview(df.union(df), "id").collect()] == [0, 1, 2]
    # Each task keeps its own first rows; nothing is sorted as a whole.
    assert "TakeOrderedAndProject" in profiling.preview(df, 4, ["id"])._jdf.queryExecution().executedPlan().toString()

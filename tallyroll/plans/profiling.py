"""Profiles of the source tables: shapes, values, duplicates, scores and readiness.

Profiles look at the rows as they came, so statuses are compared untrimmed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.functions.numbers import number_or_null, round_half_even, round_mean, text_mean
from tallyroll.operators.dedup import duplicate_summary, duplicated_rows, keep_first, key_counts
from tallyroll.operators.distribution import describe_numbers, equal_width_histogram
from tallyroll.operators.lookup import orphan_total
from tallyroll.schemas import SOURCE_COLUMNS, STATUSES, SUBJECTS

ATTENDANCE_KEY = ("student_id", "attendance_date")
ASSESSMENT_KEY = ("student_id", "subject", "assessment_date")
# The readiness checks, in order.
CHECKS = (
    "no_nulls_in_students",
    "no_nulls_in_attendance",
    "no_nulls_in_assessments",
    "unique_student_ids",
    "no_orphans_in_attendance",
    "no_orphans_in_assessments",
    "known_statuses",
    "scores_within_max",
)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows: in ``order_by`` (each task keeps its own first rows), else any, from as few files as will do."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def distinct_preview(df: DataFrame, column: str, rows: int = 3) -> DataFrame:
    """The least distinct values."""
    return df.select(column).distinct().orderBy(column).limit(rows)


# --- files ------------------------------------------------------------------
def file_order(stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per file of a table: its rows, first and last key in ``order``, and rows that come before a smaller key.

    Places are those that Spark's file metadata gives. ``overlaps`` tells whether another file that begins earlier in ``order``
    ends later than this one begins. No window holds more than one file, or one row per file.
    """
    key = F.struct(*order)
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"), key.alias("key"))
    inside = Window.partitionBy("file").orderBy("place")
    rows = rows.withColumn("inverted", F.coalesce(F.col("key") < F.lag("key").over(inside), F.lit(False)))
    files = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("inverted").alias("inversions"),
        F.min_by("key", "place").alias("first_key"),
        F.max_by("key", "place").alias("last_key"),
        F.min("key").alias("least"),
        F.max("key").alias("most"),
    )
    earlier = Window.orderBy("least", "most", "file").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = F.coalesce(F.max("most").over(earlier) > F.col("least"), F.lit(False)).alias("overlaps")
    return files.select("file", "row_count", "inversions", "first_key", "last_key", overlaps)


def load_order(stored: DataFrame, table: str, order: Sequence[str]) -> DataFrame:
    """One row on how a table lies on storage: rows, inversions inside files, files that overlap, first and last key."""
    def shown(key: str) -> Column:
        return F.concat_ws("|", *[F.col(f"{key}.{c}").cast("string") for c in order])

    files = file_order(stored, order)
    total = files.agg(
        F.sum("row_count").alias("row_count"),
        F.sum("inversions").alias("inversions"),
        F.count_if("overlaps").alias("overlaps"),
        F.min("first_key").alias("first"),
        F.max("last_key").alias("last"),
    )
    return total.select(
        F.lit(table).alias("table_name"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("row_count", "inversions", "overlaps")],
        shown("first").alias("first_key"),
        shown("last").alias("last_key"),
    )


def inferred_schema(df: DataFrame, table: str) -> DataFrame:
    """One row per column of a typed read: the kind of type that was found, and how many cells are NULL."""
    # Names of kinds for Spark's own type names.
    kinds = {"int": "integer", "bigint": "integer", "double": "double", "date": "date", "string": "string"}
    found = [(c, kinds.get(t, "timestamp" if t.startswith("timestamp") else t)) for c, t in df.dtypes]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, (c, _) in enumerate(found)])
    stacked = ", ".join(f"'{c}', '{kind}', nulls_{i}" for i, (c, kind) in enumerate(found))
    return counted.selectExpr(
        f"'{table}' as table_name", "row_count", f"stack({len(found)}, {stacked}) as (column_name, kind, null_count)"
    )


# --- shape and values -------------------------------------------------------
def shape_and_nulls(df: DataFrame, table: str) -> DataFrame:
    """One row per column, from one pass: rows, columns, NULLs here and in total."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(names)],
    )
    stacked = ", ".join(f"'{c}', nulls_{i}" for i, c in enumerate(names))
    total = " + ".join(f"nulls_{i}" for i in range(len(names)))
    return counted.selectExpr(
        f"'{table}' as table_name",
        "row_count",
        f"{len(names)} as column_count",
        f"{total} as table_nulls",
        f"stack({len(names)}, {stacked}) as (column_name, null_count)",
    )


def _column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of several columns with their counts, in one scan and one shuffle."""
    stacked = ", ".join(f"'{c}', cast({c} as string)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {stacked}) as (column_name, value)")
    return long.where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))


def value_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Non-NULL values with their counts, most frequent first within a column."""
    return (
        _column_values(df, columns)
        .select(F.lit(table).alias("table_name"), "column_name", "value", "value_count")
        .orderBy("column_name", F.col("value_count").desc(), "value")
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of one column, in key order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def distinct_values(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """The distinct values themselves, as rows in order rather than one array."""
    return (
        _column_values(df, columns)
        .select(F.lit(table).alias("table_name"), "column_name", "value")
        .orderBy("column_name", "value")
    )


def distinct_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return (
        _column_values(df, columns)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_count"))
        .select(F.lit(table).alias("table_name"), "column_name", "distinct_count")
    )


def date_range(df: DataFrame, table: str, column: str) -> DataFrame:
    day = F.col(column).cast("timestamp_ntz").cast("date")
    return df.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "first_date", "last_date"
    )


def rows_per_day(attendance: DataFrame) -> DataFrame:
    day = F.col("attendance_date").cast("timestamp_ntz").cast("date")
    return attendance.groupBy(day.alias("attendance_date")).agg(F.count(F.lit(1)).alias("row_count")).orderBy("attendance_date")


# --- duplicates -------------------------------------------------------------
def duplicates(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    return duplicate_summary(df, keys).select(
        F.lit(table).alias("table_name"),
        F.lit("+".join(keys)).alias("key_columns"),
        "row_count",
        "duplicate_count",
        "rows_in_duplicates",
    )


def repeated_attendance(attendance: DataFrame) -> DataFrame:
    """All rows of every repeated (student, day)."""
    return duplicated_rows(attendance, ATTENDANCE_KEY)


def status_signatures(attendance: DataFrame) -> DataFrame:
    """How often each combination of statuses occurs among repeated (student, day) keys.

    Rows are counted per key and status before anything is gathered, so a key
    carries one small entry per distinct status, and text is made once per
    combination. A combination longer than a text cell can be stops the job.
    """
    usable = attendance.where(" and ".join(f"{k} is not null" for k in ATTENDANCE_KEY))
    per_status = usable.groupBy(*ATTENDANCE_KEY, "status").agg(F.count(F.lit(1)).alias("n"))
    per_key = (
        per_status.groupBy(*ATTENDANCE_KEY)
        .agg(F.sum("n").alias("rows_in_key"), F.array_sort(F.collect_list(F.struct("status", "n"))).alias("mix"))
        .where("rows_in_key > 1")
    )
    counted = per_key.groupBy("mix", "rows_in_key").agg(F.count(F.lit(1)).alias("key_count"))
    spelled = "transform(mix, m -> concat(repeat(concat(m.status, '+'), cast(m.n - 1 as int)), m.status))"
    return counted.selectExpr(f"array_join({spelled}, '+') as statuses", "key_count").orderBy(F.col("key_count").desc(), "statuses")


def first_by_status(attendance: DataFrame) -> DataFrame:
    """One row per (student, day), PRESENT before ABSENT before anything else."""
    rank = F.when(F.col("status") == "PRESENT", 0).when(F.col("status") == "ABSENT", 1).otherwise(2)
    return keep_first(attendance, ATTENDANCE_KEY, [rank, F.col("attendance_id").asc_nulls_last()])


def latest_assessments(assessments: DataFrame) -> DataFrame:
    """One row per (student, subject, day): the latest."""
    latest = F.col("created_at").cast("timestamp_ntz").desc_nulls_last()
    return keep_first(assessments, ASSESSMENT_KEY, [latest, F.col("assessment_id").asc_nulls_last()])


def dedup_effect(attendance: DataFrame, assessments: DataFrame) -> DataFrame:
    """Rows kept and removed by each deduplication: a key keeps exactly one row."""
    parts = []
    for table, df, keys in (
        ("attendance", attendance, ATTENDANCE_KEY),
        ("assessments", assessments, ASSESSMENT_KEY),
    ):
        kept = F.count(F.lit(1))
        parts.append(
            key_counts(df, keys)
            .agg(kept.alias("kept_rows"), F.coalesce(F.sum("n") - kept, F.lit(0)).cast("long").alias("removed_rows"))
            .select(F.lit(table).alias("table_name"), "kept_rows", "removed_rows")
        )
    return _union(parts)


# --- scores -----------------------------------------------------------------
def score_description(assessments: DataFrame) -> DataFrame:
    return describe_numbers(assessments, "score")


def score_histogram(assessments: DataFrame) -> DataFrame:
    return equal_width_histogram(assessments, "score", 20)


def subject_means(assessments: DataFrame) -> DataFrame:
    return (
        assessments.groupBy("subject")
        .agg(round_mean(text_mean(F.col("score")), 6).alias("mean_score"))
        .orderBy(F.col("mean_score").desc_nulls_last(), "subject")
    )


def daily_means(assessments: DataFrame) -> DataFrame:
    """Mean score per day of the deduplicated rows, with the mean of the daily means."""
    day = F.col("assessment_date").cast("timestamp_ntz").cast("date")
    daily = (
        latest_assessments(assessments)
        .groupBy(day.alias("assessment_date"))
        .agg(round_mean(text_mean(F.col("score")), 6).alias("mean_score"))
    )
    overall = daily.agg(round_mean(F.avg("mean_score"), 6)).scalar()
    return daily.withColumn("mean_of_days", overall).orderBy("assessment_date")


def subject_pivot(assessments: DataFrame, students: DataFrame, subjects: Sequence[str] | None = SUBJECTS) -> DataFrame:
    """Mean score of every class and subject, rounded to two digits.

    With ``subjects=None`` Spark looks up the distinct subjects first.
    """
    scored = latest_assessments(assessments).join(students.select("student_id", "class_id"), "student_id")
    pivoted = scored.groupBy("class_id").pivot("subject", list(subjects) if subjects else None)
    means = pivoted.agg(round_mean(text_mean(F.col("score")), 2))
    return means.orderBy("class_id")


# --- classes ----------------------------------------------------------------
def class_attendance(attendance: DataFrame, students: DataFrame) -> DataFrame:
    """Attendance rate per class over the recorded days, all enrolment statuses counted.

    ``first_by_status`` keeps a PRESENT row whenever a student's day has one, so
    here a hash aggregate with that question does instead of the sorted ranking.
    Classes are matched by id; a class without a PRESENT row has rate 0.
    """
    student_days = attendance.groupBy(*ATTENDANCE_KEY).agg(F.bool_or(F.col("status") == "PRESENT").alias("present"))
    placed = student_days.join(students.select("student_id", "class_id"), "student_id")
    sizes = students.groupBy("class_id").agg(F.count("student_id").alias("total_students"))
    seen = placed.groupBy("class_id").agg(
        F.count_if("present").alias("total_present"), F.count_distinct("attendance_date").alias("days_recorded")
    )
    rate = F.try_divide(F.col("total_present").cast("double"), F.col("total_students") * F.col("days_recorded"))
    return (
        sizes.join(seen, "class_id", "left")
        .na.fill(0, ["total_present", "days_recorded"])
        .withColumn("avg_daily_attendance_rate", F.coalesce(round_half_even(rate, 4), F.lit(0.0)))
        .orderBy("class_id")
    )


# --- readiness --------------------------------------------------------------
def _checks(df: DataFrame, checks: Mapping[int, str]) -> DataFrame:
    """``(seq, check, passed)`` rows from one pass; a check is a predicate of rows that break it."""
    counted = df.agg(*[F.expr(f"count_if({broken}) = 0 as check_{seq}") for seq, broken in checks.items()])
    stacked = ", ".join(f"{seq}, '{CHECKS[seq - 1]}', check_{seq}" for seq in checks)
    return counted.selectExpr(f"stack({len(checks)}, {stacked}) as (seq, check, passed)")


def _any_null(entity: str) -> str:
    return " or ".join(f"{c} is null" for c in SOURCE_COLUMNS[entity])


def readiness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The eight checks over all three sources, one row each."""
    students, attendance, assessments = (tables[n] for n in ("students", "attendance", "assessments"))
    statuses = ", ".join(f"'{s}'" for s in STATUSES)
    score, most = number_or_null("score"), number_or_null("max_score")
    return _union(
        [
            _checks(students, {1: _any_null("students")}),
            _checks(attendance, {2: _any_null("attendance"), 7: f"not coalesce(status in ({statuses}), false)"}),
            _checks(assessments, {3: _any_null("assessments"), 8: f"not coalesce({score} <= {most}, false)"}),
            _checks(duplicate_summary(students, ["student_id"]), {4: "duplicate_count > 0"}),
            _checks(orphan_total(attendance, students, "student_id"), {5: "orphan_count > 0"}),
            _checks(orphan_total(assessments, students, "student_id"), {6: "orphan_count > 0"}),
        ]
    )

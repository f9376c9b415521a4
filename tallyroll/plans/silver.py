"""Bronze text to typed, trimmed and deduplicated Silver rows.

``batch_passed`` is the verdict of the quality suite for the whole batch: a
Python bool, or a scalar subquery column. It is stamped on every row and never
filters one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.numbers import round_half_away, text_to_integer
from tallyroll.operators.dedup import keep_first
from tallyroll.schemas import SOURCE_FILES, STATUSES, UTC_NOW


def _audit(entity: str, batch_passed: bool | Column) -> list[Column]:
    verdict = batch_passed if isinstance(batch_passed, Column) else F.lit(batch_passed)
    return [
        F.expr(UTC_NOW).alias("_ingested_at"),
        F.lit(SOURCE_FILES[entity]).alias("_source"),
        verdict.cast("boolean").alias("_ge_passed"),
    ]


def silver_students(raw: DataFrame, batch_passed: bool | Column = True) -> DataFrame:
    """Trim and cast; rows without a student id are dropped. Ids are unique at the source."""
    return raw.where(F.col("student_id").isNotNull() & (F.trim("student_id") != "")).select(
        F.trim("student_id").alias("student_id"),
        F.trim("student_name").alias("student_name"),
        F.trim("class_id").alias("class_id"),
        text_to_integer(F.col("grade_level")).alias("grade_level"),
        F.upper(F.trim("enrollment_status")).alias("enrollment_status"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        *_audit("students", batch_passed),
    )


def silver_attendance(raw: DataFrame, batch_passed: bool | Column = True) -> DataFrame:
    """One row per student and day: PRESENT before ABSENT, then the latest record.

    Duplicates are found on the untrimmed keys, so those are trimmed last; all
    other columns are typed before the shuffle, which makes its rows narrower.
    Of the two statuses left, descending order puts PRESENT first. The id
    breaks ties that the order leaves open.
    """
    status = F.upper(F.trim("status"))
    usable = raw.where(
        F.col("student_id").isNotNull() & F.col("attendance_date").isNotNull() & status.isin(*STATUSES)
    ).select(
        "attendance_id",
        "student_id",
        "attendance_date",
        status.alias("status"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
    )
    order = [F.col("status").desc(), F.col("created_at").desc_nulls_last(), F.col("attendance_id").asc_nulls_last()]
    return keep_first(usable, ["student_id", "attendance_date"], order).select(
        "attendance_id",
        F.trim("student_id").alias("student_id"),
        F.col("attendance_date").cast("date").alias("attendance_date"),
        "status",
        "created_at",
        *_audit("attendance", batch_passed),
    )


def silver_assessments(raw: DataFrame, batch_passed: bool | Column = True) -> DataFrame:
    """The latest record per student, subject and day, with scores inside ``0..max_score``.

    ``max_score`` 0 with ``score`` 0 passes the guard; its normalised score is
    NULL and the Gold contract rejects it.
    """
    usable = (
        raw.where(F.col("student_id").isNotNull() & F.col("assessment_date").isNotNull())
        .select(
            "assessment_id",
            "student_id",
            "subject",
            F.col("score").cast("double").alias("score"),
            F.col("max_score").cast("double").alias("max_score"),
            "assessment_date",
            F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        )
        .where("score >= 0 and score <= max_score")
    )
    order = [F.col("created_at").desc_nulls_last(), F.col("assessment_id").asc_nulls_last()]
    return keep_first(usable, ["student_id", "subject", "assessment_date"], order).select(
        "assessment_id",
        F.trim("student_id").alias("student_id"),
        F.trim("subject").alias("subject"),
        "score",
        "max_score",
        round_half_away(F.try_divide("score", "max_score") * F.lit(100.0), 2).alias("normalized_score"),
        F.col("assessment_date").cast("date").alias("assessment_date"),
        "created_at",
        *_audit("assessments", batch_passed),
    )


SILVER = {
    "students": silver_students,
    "attendance": silver_attendance,
    "assessments": silver_assessments,
}

"""One row per class and day with any activity."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyroll.functions.numbers import exact_avg, exact_ratio
from tallyroll.schemas import MART

SCORE = DecimalType(6, 2)


def class_sizes(dim: DataFrame) -> DataFrame:
    """ACTIVE students per class."""
    return (
        dim.where(F.col("enrollment_status") == "ACTIVE")
        .groupBy("class_id")
        .agg(F.count_distinct("student_id").alias("total_students"))
    )


def attendance_by_class_day(attendance: DataFrame) -> DataFrame:
    """Students seen and PRESENT / ABSENT rows per class and day.

    Spark first groups by class, day and student, so one big class is spread
    over its students before the final count.
    """
    return attendance.groupBy("class_id", F.col("attendance_date").alias("date")).agg(
        F.count_distinct("student_id").alias("students_with_attendance"),
        F.count_if(F.col("status") == "PRESENT").alias("present_count"),
        F.count_if(F.col("status") == "ABSENT").alias("absent_count"),
    )


def assessments_by_class_day(assessments: DataFrame) -> DataFrame:
    """Students assessed, assessments and mean raw score per class and day."""
    return assessments.groupBy("class_id", F.col("assessment_date").alias("date")).agg(
        F.count_distinct("student_id").alias("students_with_assessment"),
        F.count(F.lit(1)).alias("assessment_count"),
        exact_avg(F.col("score").cast(SCORE), 2).cast(SCORE).alias("avg_score"),
    )


def activity_keys(by_attendance: DataFrame, by_assessment: DataFrame) -> DataFrame:
    """Distinct (class, day) keys of both aggregates; NULL keys count as equal."""
    keys = ["class_id", "date"]
    return by_attendance.select(*keys).union(by_assessment.select(*keys)).distinct()


def class_daily_performance(
    dim: DataFrame, attendance: DataFrame, assessments: DataFrame, computed_at: datetime | Column | None = None
) -> DataFrame:
    """The mart.

    Both aggregates are stacked, each with NULL for the measures of the other, and
    grouped once more by key: each fact is read once, a second shuffle carries
    aggregates only, and a filter on class or day goes through to both facts,
    which it would not through a full outer join. A NULL class finds no class size
    and drops out, as does a class without an ACTIVE student. ``attendance_rate``
    can pass 1: it divides rows of all students by ACTIVE students. Days without
    assessments carry a score of 0.00.
    """
    if computed_at is None:
        computed_at = datetime.now(timezone.utc).replace(tzinfo=None)
    stamp = computed_at if isinstance(computed_at, Column) else F.lit(computed_at.isoformat(sep=" "))

    keys = ["class_id", "date"]
    stacked = attendance_by_class_day(attendance).unionByName(
        assessments_by_class_day(assessments), allowMissingColumns=True
    )
    activity = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])
    zero = F.lit(0)
    return activity.join(class_sizes(dim), "class_id").select(
        "class_id",
        "date",
        F.col("total_students").cast("int").alias("total_students"),
        F.coalesce("students_with_attendance", zero).cast("int").alias("students_with_attendance"),
        F.coalesce("present_count", zero).cast("int").alias("present_count"),
        F.coalesce("absent_count", zero).cast("int").alias("absent_count"),
        exact_ratio(F.coalesce("present_count", zero), F.col("total_students"), 4).alias("attendance_rate"),
        F.coalesce("students_with_assessment", zero).cast("int").alias("students_with_assessment"),
        F.coalesce("assessment_count", zero).cast("int").alias("assessment_count"),
        F.coalesce("avg_score", F.lit(0).cast(SCORE)).alias("avg_score"),
        stamp.cast("timestamp_ntz").alias("_computed_at"),
    ).select(*MART.columns)

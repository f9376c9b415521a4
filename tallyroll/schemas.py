"""Source columns, fixed value sets and the contracts of the serving tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values -----------------------------------------------------------
STATUSES = ("PRESENT", "ABSENT")
ENROLLMENT_STATUSES = ("ACTIVE", "INACTIVE", "DROPPED", "SUSPENDED")
SUBJECTS = ("Math", "Science", "English", "History")
GRADE_LEVELS = ("10", "11", "12")
STUDENT_ID_PATTERN = "^S-[0-9]{4}$"
CLASS_ID_PATTERN = "^CLASS-[0-9]{2}$"

ENTITIES = ("students", "attendance", "assessments")

SOURCE_FILES = {
    "students": "students.csv",
    "attendance": "attendance.csv",
    "assessments": "assessments.json",
}

SOURCE_COLUMNS = {
    "students": ("student_id", "student_name", "class_id", "grade_level", "enrollment_status", "updated_at"),
    "attendance": ("attendance_id", "student_id", "attendance_date", "status", "created_at"),
    "assessments": (
        "assessment_id",
        "student_id",
        "subject",
        "score",
        "max_score",
        "assessment_date",
        "created_at",
    ),
}


def text_schema(columns) -> StructType:
    """Every column a nullable string: nothing is typed before Silver."""
    return StructType([StructField(name, StringType(), True) for name in columns])


# --- serving contracts ------------------------------------------------------
@dataclass(frozen=True)
class Field:
    """One serving column. ``default`` is SQL text, used when the column is left out."""

    name: str
    type: str
    nullable: bool = False
    max_length: int | None = None
    allowed: tuple[str, ...] | None = None
    default: str | None = None


@dataclass(frozen=True)
class Contract:
    table: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    # Order of rows inside each file, so that row groups can be skipped.
    sort: tuple[str, ...]
    # A date of the key: rows are kept in one folder per day, and a merge touches only the days of its batch.
    day: str | None = None

    def __post_init__(self):
        if self.day is not None and self.day not in self.key:
            raise ValueError(f"{self.table}: the day must be part of the key")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> str:
        return ", ".join(f"{f.name} {f.type}" for f in self.fields)


# The time in UTC, whatever the zone of the session.
UTC_NOW = "timestampadd(MICROSECOND, unix_micros(current_timestamp()), timestamp_ntz'1970-01-01 00:00:00')"


def _text(name: str, length: int, **more) -> Field:
    return Field(name, "string", max_length=length, **more)


DIM_STUDENTS = Contract(
    "dim_students",
    ("student_id",),
    (
        _text("student_id", 20),
        _text("student_name", 100),
        _text("class_id", 20),
        Field("grade_level", "int"),
        _text("enrollment_status", 20),
        Field("updated_at", "timestamp_ntz"),
        Field("_ingested_at", "timestamp_ntz", default=UTC_NOW),
    ),
    sort=("student_id",),
)

FACT_ATTENDANCE = Contract(
    "fact_attendance",
    ("attendance_id",),
    (
        _text("attendance_id", 20),
        _text("student_id", 20),
        _text("class_id", 20),
        Field("attendance_date", "date"),
        _text("status", 10, allowed=STATUSES),
        Field("created_at", "timestamp_ntz"),
        Field("_ingested_at", "timestamp_ntz", default=UTC_NOW),
    ),
    sort=("attendance_date", "student_id"),
)

FACT_ASSESSMENTS = Contract(
    "fact_assessments",
    ("assessment_id",),
    (
        _text("assessment_id", 20),
        _text("student_id", 20),
        _text("class_id", 20),
        _text("subject", 50),
        Field("score", "decimal(6,2)"),
        Field("max_score", "decimal(6,2)"),
        Field("normalized_score", "decimal(6,2)"),
        Field("assessment_date", "date"),
        Field("created_at", "timestamp_ntz"),
        Field("_ingested_at", "timestamp_ntz", default=UTC_NOW),
    ),
    sort=("assessment_date", "student_id"),
)

MART = Contract(
    "mart_class_daily_performance",
    ("class_id", "date"),
    (
        _text("class_id", 20),
        Field("date", "date"),
        Field("total_students", "int", default="0"),
        Field("students_with_attendance", "int", default="0"),
        Field("present_count", "int", default="0"),
        Field("absent_count", "int", default="0"),
        Field("attendance_rate", "decimal(5,4)", nullable=True),
        Field("students_with_assessment", "int", default="0"),
        Field("assessment_count", "int", default="0"),
        Field("avg_score", "decimal(6,2)", nullable=True, default="0.00"),
        Field("_computed_at", "timestamp_ntz", default=UTC_NOW),
    ),
    sort=("date", "class_id"),
    day="date",
)

CONTRACTS = {c.table: c for c in (DIM_STUDENTS, FACT_ATTENDANCE, FACT_ASSESSMENTS, MART)}

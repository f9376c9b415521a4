"""Dashboard-style reports and the named questions asked of the serving tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyroll.functions.numbers import exact_avg, exact_mean
from tallyroll.schemas import MART

# --- fixed values -----------------------------------------------------------
GRAINS = {"P1D": "day", "P1W": "week", "P1M": "month", "P3M": "quarter", "P1Y": "year"}
# ----------------------------------------------------------------------------
MART_REPORT_COLUMNS = [c for c in MART.columns if not c.startswith("_")]


@dataclass(frozen=True)
class Metric:
    column: str
    aggregate: str
    label: str


def metric(column: str, aggregate: str, label: str | None = None) -> Metric:
    return Metric(column, aggregate.upper(), label or f"{aggregate}({column})")


def _aggregate(df: DataFrame, m: Metric) -> Column:
    column = F.col(m.column)
    if m.aggregate == "AVG":
        decimal = isinstance(df.schema[m.column].dataType, DecimalType)
        return exact_mean(column) if decimal else F.avg(column)
    functions = {
        "SUM": F.sum,
        "COUNT": F.count,
        "COUNT_DISTINCT": F.count_distinct,
        "MIN": F.min,
        "MAX": F.max,
    }
    return functions[m.aggregate](column)


def report(
    df: DataFrame,
    metrics: Sequence[Metric] = (),
    groupby: Sequence[str] = (),
    *,
    time_column: str | None = None,
    grain: str | None = None,
    columns: Sequence[str] = (),
    order_by: Sequence[str] = (),
    row_limit: int | None = None,
) -> DataFrame:
    """Grouped metrics, or plain ``columns`` when no metric is asked for.

    Groups come with the largest first metric first, ties by group, so a row
    limit always keeps the same rows. Without one all rows are returned.
    """
    if not metrics:
        ordered = df.select(*columns).orderBy(*(order_by or columns))
        return ordered if row_limit is None else ordered.limit(row_limit)

    keys = [F.col(name) for name in groupby]
    names = list(groupby)
    if time_column is not None:
        bucket = F.date_trunc(GRAINS[grain or "P1D"], F.col(time_column)).cast("date")
        keys.insert(0, bucket.alias(time_column))
        names.insert(0, time_column)
    grouped = df.groupBy(*keys).agg(*[_aggregate(df, m).alias(m.label) for m in metrics])
    ordered = grouped.orderBy(F.col(f"`{metrics[0].label}`").desc_nulls_last(), *names)
    return ordered if row_limit is None else ordered.limit(row_limit)


@dataclass(frozen=True)
class Request:
    """What a client asks of a table; see ``report``. ``row_limit`` is None where the client names none."""

    metrics: Sequence[Metric] = ()
    groupby: Sequence[str] = ()
    time_column: str | None = None
    grain: str | None = None
    columns: Sequence[str] = ()
    order_by: Sequence[str] = ()
    row_limit: int | None = None


@dataclass(frozen=True)
class RequestSettings:
    """What a server does for requests that leave it open. Without a ``default_limit`` they get all rows."""

    default_limit: int | None = None

    def __post_init__(self):
        if self.default_limit is not None and self.default_limit < 1:
            raise ValueError("a default limit is at least one row")

    def limit_of(self, request: Request) -> int | None:
        """A limit that the client names is the client's, larger or smaller than the default."""
        return request.row_limit if request.row_limit is not None else self.default_limit


def answer(df: DataFrame, request: Request, settings: RequestSettings = RequestSettings()) -> DataFrame:
    """The report that ``request`` asks for, under the server's ``settings``."""
    asked = {f.name: getattr(request, f.name) for f in fields(request) if f.name != "row_limit"}
    return report(df, **asked, row_limit=settings.limit_of(request))


# --- dashboard --------------------------------------------------------------
def attendance_rate_trend(mart: DataFrame) -> DataFrame:
    return report(
        mart,
        [metric("attendance_rate", "AVG", "Avg Attendance Rate")],
        ["class_id"],
        time_column="date",
        grain="P1D",
        row_limit=10_000,
    )


def score_by_class(mart: DataFrame) -> DataFrame:
    return report(mart, [metric("avg_score", "AVG", "Avg Score")], ["class_id"], row_limit=50)


def present_absent_by_class(mart: DataFrame) -> DataFrame:
    wanted = [metric("present_count", "SUM", "Present"), metric("absent_count", "SUM", "Absent")]
    return report(mart, wanted, ["class_id"], row_limit=50)


def score_by_subject(assessments: DataFrame) -> DataFrame:
    return report(assessments, [metric("score", "AVG", "Avg Score")], ["subject"], row_limit=10)


def mart_table(mart: DataFrame) -> DataFrame:
    return report(mart, columns=MART_REPORT_COLUMNS, order_by=["class_id", "date"], row_limit=500)


# --- named questions --------------------------------------------------------
def full_mart(mart: DataFrame) -> DataFrame:
    return mart.orderBy("class_id", "date")


def mart_head(mart: DataFrame, rows: int = 20) -> DataFrame:
    return full_mart(mart).limit(rows)


def class_averages(mart: DataFrame) -> DataFrame:
    """Mean rate in percent and mean daily score; days at zero are part of both means."""
    return (
        mart.groupBy("class_id")
        .agg(
            exact_avg(F.col("attendance_rate") * 100, 2).alias("avg_attendance_pct"),
            exact_avg(F.col("avg_score"), 2).alias("avg_score"),
        )
        .orderBy("class_id")
    )


def lowest_attendance(mart: DataFrame, day: date | str) -> DataFrame:
    return (
        mart.where(F.col("date") == F.lit(str(day)).cast("date"))
        .select("class_id", "date", "present_count", "total_students", "attendance_rate")
        .orderBy(F.col("attendance_rate").asc_nulls_last(), "class_id")
    )


def class_trend(mart: DataFrame, class_id: str) -> DataFrame:
    return (
        mart.where(F.col("class_id") == class_id)
        .select("date", "present_count", "absent_count", "attendance_rate", "avg_score")
        .orderBy("date")
    )


def students_per_class_and_grade(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("class_id", "grade_level")
        .agg(F.count(F.lit(1)).alias("students"))
        .orderBy("class_id", "grade_level")
    )


def subject_averages(assessments: DataFrame) -> DataFrame:
    return (
        assessments.groupBy("subject")
        .agg(exact_avg(F.col("score"), 2).alias("avg_score"), F.count(F.lit(1)).alias("assessments"))
        .orderBy(F.col("avg_score").desc_nulls_last(), "subject")
    )


def top_students(assessments: DataFrame, dim: DataFrame, rows: int = 5) -> DataFrame:
    """Best mean scores. Scores are averaged per student before the join: the key is unique in ``dim``."""
    averages = assessments.groupBy("student_id").agg(exact_avg(F.col("score"), 2).alias("avg_score"))
    return (
        averages.join(dim.select("student_id", "class_id"), "student_id")
        .select("student_id", "class_id", "avg_score")
        .orderBy(F.col("avg_score").desc_nulls_last(), "student_id")
        .limit(rows)
    )


def attendance_detail(attendance: DataFrame, dim: DataFrame, day: date | str) -> DataFrame:
    on_day = attendance.where(F.col("attendance_date") == F.lit(str(day)).cast("date"))
    return (
        on_day.join(dim.select("student_id", "student_name"), "student_id")
        .select("student_id", "student_name", "class_id", "status")
        .orderBy("class_id", "student_id")
    )


def audit_rollup(silver: DataFrame) -> DataFrame:
    """Rows per source and batch verdict."""
    return silver.groupBy("_source", "_ge_passed").agg(F.count(F.lit(1)).alias("rows"))

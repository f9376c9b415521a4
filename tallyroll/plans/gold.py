"""Silver to the serving dimension and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.numbers import round_half_away
from tallyroll.operators.lookup import add_columns_from
from tallyroll.schemas import DIM_STUDENTS, FACT_ASSESSMENTS, FACT_ATTENDANCE, Contract


def dim_students(students: DataFrame) -> DataFrame:
    return students.select(*DIM_STUDENTS.columns)


def fact_attendance(attendance: DataFrame, students: DataFrame) -> DataFrame:
    """Attendance with the class of the student; an orphan keeps a NULL class.

    After Silver a student has at most one row per day, so no student can
    dominate this join.
    """
    return add_columns_from(attendance, students, "student_id", ["class_id"]).select(*FACT_ATTENDANCE.columns)


def fact_assessments(assessments: DataFrame, students: DataFrame) -> DataFrame:
    """Assessments with the class of the student and two-digit scores."""
    scores = {
        name: round_half_away(F.col(name).cast("double"), 2) for name in ("score", "max_score", "normalized_score")
    }
    joined = add_columns_from(assessments.withColumns(scores), students, "student_id", ["class_id"])
    return joined.select(*FACT_ASSESSMENTS.columns)


def with_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    """Add the columns ``df`` leaves out, each at its declared default.

    As in SQL, a NULL that is there stays NULL and is judged by the contract.
    """
    have = set(df.columns)
    added = {
        f.name: F.expr(f.default if f.default is not None else "null").cast(f.type)
        for f in contract.fields
        if f.name not in have
    }
    return df.withColumns(added).select(*contract.columns) if added else df.select(*contract.columns)


def typed(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast to the serving types; a number out of range stops the job."""
    return df.selectExpr(*[f"cast({f.name} as {f.type}) as {f.name}" for f in contract.fields])


def typed_if_possible(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast to the serving types; a number out of range becomes NULL.

    Only for rows whose contract is judged on the uncast values.
    """
    return df.selectExpr(*[f"try_cast({f.name} as {f.type}) as {f.name}" for f in contract.fields])

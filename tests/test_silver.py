"""Typing, filters and deduplication on rows written out by hand."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyroll.plans.silver import silver_assessments, silver_attendance, silver_students
from tallyroll.schemas import SOURCE_COLUMNS, text_schema


def frame(spark, entity, rows):
    return spark.createDataFrame(rows, text_schema(SOURCE_COLUMNS[entity]))


def attendance(spark, *rows):
    return frame(spark, "attendance", list(rows))


def test_present_wins_then_the_latest(spark):
    raw = attendance(
        spark,
        ("A1", "S-1", "2024-01-02", "ABSENT", "2024-01-02 10:00:00"),
        ("A2", "S-1", "2024-01-02", "PRESENT", "2024-01-02 08:00:00"),
        ("A3", "S-1", "2024-01-02", " present", "2024-01-02 09:00:00"),
    )
    (row,) = silver_attendance(raw).collect()
    assert (row.attendance_id, row.status, row.created_at) == ("A3", "PRESENT", datetime(2024, 1, 2, 9))
    assert row._source == "attendance.csv" and row._ge_passed is True


def test_padded_keys_are_not_duplicates(spark):
    raw = attendance(
        spark,
        ("A1", "S-1", "2024-01-02", "PRESENT", "2024-01-02 08:00:00"),
        ("A2", "S-1 ", "2024-01-02", "PRESENT", "2024-01-02 09:00:00"),
    )
    rows = silver_attendance(raw).collect()
    assert sorted(r.attendance_id for r in rows) == ["A1", "A2"]
    assert {r.student_id for r in rows} == {"S-1"}


def test_unknown_or_missing_status_is_dropped(spark):
    raw = attendance(
        spark,
        ("A1", "S-1", "2024-01-02", "LATE", "2024-01-02 08:00:00"),
        ("A2", "S-2", "2024-01-02", None, "2024-01-02 08:00:00"),
        ("A3", None, "2024-01-02", "PRESENT", "2024-01-02 08:00:00"),
        ("A4", "S-3", None, "PRESENT", "2024-01-02 08:00:00"),
        ("A5", "S-4", "2024-01-02", "absent", "2024-01-02 08:00:00"),
    )
    assert [r.attendance_id for r in silver_attendance(raw).collect()] == ["A5"]


def test_blank_student_ids_are_dropped(spark):
    tail = ("Ann ", " CLASS-01", "10.0", " active", "2025-01-01 00:00:00")
    raw = frame(spark, "students", [("", *tail), ("   ", *tail), (None, *tail), (" S-1 ", *tail)])
    (row,) = silver_students(raw, False).collect()
    assert (row.student_id, row.student_name, row.class_id) == ("S-1", "Ann", "CLASS-01")
    assert (row.grade_level, row.enrollment_status, row._ge_passed) == (10, "ACTIVE", False)


def assessment(score, top, made="08:00:00", key="E1", student="S-1"):
    return (key, student, "Math", score, top, "2024-01-02", f"2024-01-02 {made}")


def test_score_range_guard(spark):
    rows = [assessment(s, "100", key=f"E{s}", student=f"S{s}") for s in ("-1", "0", "100", "101")]
    kept = silver_assessments(frame(spark, "assessments", rows)).collect()
    assert sorted(r.score for r in kept) == [0.0, 100.0]


def test_latest_assessment_wins(spark):
    rows = [assessment("50", "100", "08:00:00", "E1"), assessment("40", "80", "09:00:00", "E2")]
    (row,) = silver_assessments(frame(spark, "assessments", rows)).collect()
    assert (row.assessment_id, row.normalized_score) == ("E2", 50.0)


def test_zero_max_score_gives_null(spark):
    (row,) = silver_assessments(frame(spark, "assessments", [assessment("0", "0")])).collect()
    assert row.normalized_score is None


@pytest.mark.parametrize("score, top, expected", [("1.005", "100", 1.0), ("0.285", "100", 0.28), ("2", "3", 66.67)])
def test_normalised_score_rounds_the_scaled_double(spark, score, top, expected):
    (row,) = silver_assessments(frame(spark, "assessments", [assessment(score, top)])).collect()
    assert row.normalized_score == expected


def test_unparsable_score_stops_the_cast(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver_assessments(frame(spark, "assessments", [assessment("n/a", "100")])).collect()


record = st.tuples(
    st.sampled_from(["S-1", "S-2", "S-2 "]),
    st.sampled_from(["2024-01-01", "2024-01-02"]),
    st.sampled_from(["PRESENT", "ABSENT", "present ", "LATE"]),
    st.integers(0, 23),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=12))
def test_dedup_keeps_the_best_row_of_every_key(spark, records):
    rows = [(f"A{i:02d}", s, d, status, f"{d} {h:02d}:00:00") for i, (s, d, status, h) in enumerate(records)]
    best = {}
    for key, student, day, status, made in rows:
        clean = status.strip().upper()
        if clean not in ("PRESENT", "ABSENT"):
            continue
        rank = (clean != "PRESENT", [-ord(c) for c in made], key)
        if (student, day) not in best or rank < best[student, day]:
            best[student, day] = rank
    got = silver_attendance(attendance(spark, *rows)).collect()
    assert sorted(r.attendance_id for r in got) == sorted(rank[2] for rank in best.values())

"""Rules, suites and the contracts of the serving tables."""

from tallyroll.plans import quality
from tallyroll.schemas import FACT_ATTENDANCE, SOURCE_COLUMNS, text_schema

GOOD = {
    "students": ("S-0001", "Ann", "CLASS-01", "10", "ACTIVE", "2025-01-01 00:00:00"),
    "attendance": ("A1", "S-0001", "2024-01-02", "PRESENT", "2024-01-02 08:00:00"),
    "assessments": ("E1", "S-0001", "Math", "50", "100", "2024-01-02", "2024-01-02 08:00:00"),
}


def frame(spark, entity, *rows):
    return spark.createDataFrame(list(rows), text_schema(SOURCE_COLUMNS[entity]))


def change(entity, **cells):
    return tuple(cells.get(c, v) for c, v in zip(SOURCE_COLUMNS[entity], GOOD[entity]))


def failures(spark, entity, *rows, engine="primary"):
    return quality.run_suite(frame(spark, entity, *rows), entity, engine)["failed_expectations"]


def test_good_and_empty_batches_pass(spark):
    for entity, row in GOOD.items():
        for engine in ("primary", "fallback"):
            assert failures(spark, entity, row, engine=engine) == []
            assert failures(spark, entity, engine=engine) == []


def test_primary_reports_expectation_types_in_order(spark):
    rows = [change("students", student_id=" S-1", student_name=None, enrollment_status="active")]
    assert failures(spark, "students", *rows) == [quality.REGEX, quality.NOT_NULL, quality.IN_SET]


def test_primary_statistics(spark):
    result = quality.run_suite(frame(spark, "attendance", change("attendance", status="LATE")), "attendance")
    assert result["success"] is False and result["engine"] == "primary" and result["checked_rows"] == 1
    assert result["statistics"] == {
        "evaluated_expectations": 7,
        "successful_expectations": 6,
        "unsuccessful_expectations": 1,
        "success_percent": 100.0 * 6 / 7,
    }


def test_rule_sets_differ(spark):
    grade = change("students", grade_level="9")
    assert failures(spark, "students", grade) == []
    assert failures(spark, "students", grade, engine="fallback") == ["grade_level_valid"]
    name = change("students", student_name=None)
    assert failures(spark, "students", name) == [quality.NOT_NULL]
    assert failures(spark, "students", name, engine="fallback") == []


def test_null_outside_the_set_only_in_fallback(spark):
    row = change("assessments", subject=None)
    assert failures(spark, "assessments", row) == [quality.NOT_NULL]
    assert failures(spark, "assessments", row, engine="fallback") == ["subject_valid"]


def test_repeated_nulls_break_uniqueness_only_in_fallback(spark):
    rows = [change("attendance", attendance_id=None)] * 2
    assert failures(spark, "attendance", *rows) == [quality.NOT_NULL]
    assert failures(spark, "attendance", *rows, engine="fallback") == ["attendance_id_not_null", "attendance_id_unique"]


def test_unparsable_and_out_of_range_scores(spark):
    bad = change("assessments", score="n/a")
    assert failures(spark, "assessments", bad) == []
    assert failures(spark, "assessments", bad, engine="fallback") == ["score_non_negative", "score_lte_max"]
    assert failures(spark, "assessments", change("assessments", max_score="NaN"), engine="fallback") == ["score_lte_max"]
    high = change("assessments", score="101")
    assert failures(spark, "assessments", high, engine="fallback") == ["score_lte_max"]


def test_duplicates_are_counted_as_rows(spark):
    rows = [GOOD["attendance"]] * 3 + [change("attendance", attendance_id="A2")]
    results = quality.evaluate(frame(spark, "attendance", *rows), quality.primary_suite("attendance"))
    (unique,) = results.where("rule = 'attendance_id_unique'").collect()
    assert (unique.checked_rows, unique.failed_rows, unique.success) == (4, 3, False)


def test_error_counts_as_passed(spark):
    result = quality.run_suite(spark.range(1), "students")
    assert result["success"] is True and result["engine"] == "error" and result["failed_expectations"] == []


def test_only_the_rule_that_raises_counts_as_passed(spark):
    rows = [change("students", class_id="bad", student_id=None), GOOD["students"]]
    df = frame(spark, "students", *rows)
    rules = quality.primary_suite("students", class_id="CLASS-[")
    results = {r.rule: r for r in quality.evaluate_isolated(df, rules).collect()}
    assert [r.seq for r in results.values()] == list(range(len(rules)))
    bad = results.pop("class_id_format")
    assert (bad.engine, bad.success, bad.checked_rows, bad.failed_rows) == ("error", True, None, None)
    others = [r for r in rules if r.name != "class_id_format"]
    alone = {r.rule: (r.checked_rows, r.failed_rows, r.success) for r in quality.evaluate(df, others).collect()}
    assert {n: (r.checked_rows, r.failed_rows, r.success) for n, r in results.items()} == alone
    assert not results["student_id_not_null"].success
    whole = quality.run_suite(df, "students", class_id="CLASS-[")
    assert whole["engine"] == "error" and whole["success"]
    isolated = quality.run_suite(df, "students", isolate=True, class_id="CLASS-[")
    assert isolated["engine"] == "primary" and isolated["failed_expectations"] == [quality.NOT_NULL]
    assert isolated["checked_rows"] == 2
    assert quality.evaluate_isolated(df, []).collect() == []


def test_lazy_verdict(spark):
    raw = frame(spark, "attendance", change("attendance", status="LATE"))
    verdict = quality.passed(raw, quality.primary_suite("attendance"))
    assert raw.select(verdict.alias("ok")).first().ok is False


def test_contract_rules(spark):
    rows = [
        ("A1", "S-1", None, "2024-01-02", "LATE", "2024-01-02 08:00:00", "2024-01-02 08:00:00"),
        ("A1", "S" * 21, "C", "2024-01-02", "PRESENT", "2024-01-02 08:00:00", "2024-01-02 08:00:00"),
    ]
    df = spark.createDataFrame(rows, text_schema(FACT_ATTENDANCE.columns))
    results = quality.evaluate(df, quality.contract_rules(FACT_ATTENDANCE))
    broken = {r.rule: r.failed_rows for r in results.where("not success").collect()}
    assert broken == {
        "fact_attendance_key_unique": 2,
        "class_id_not_null": 1,
        "status_check": 1,
        "student_id_length": 1,
    }

"""The same questions in plain SQL, to check every query against another engine.

Nothing here is shared with the Spark jobs except the source views. Averages
are rounded in whole numbers: ``(2*s + n) // (2*n)`` is ``s / n`` rounded half up.
"""

from __future__ import annotations

from tallyroll import fixtures
from tallyroll.schemas import SOURCE_COLUMNS

DAY = "2024-01-10"

_CTES = {
    "raw_students": fixtures.RAW_STUDENTS.format(customer="customer"),
    "raw_attendance": fixtures.RAW_ATTENDANCE.format(events="events"),
    "raw_assessments": fixtures.RAW_ASSESSMENTS.format(events="events"),
    "enrolled": "SELECT * FROM raw_students WHERE enrollment_status <> 'dropped'",
    "silver_students": """
        SELECT * REPLACE (TRIM(student_id) AS student_id, TRIM(student_name) AS student_name, TRIM(class_id) AS class_id,
                          grade_level::INTEGER AS grade_level, UPPER(TRIM(enrollment_status)) AS enrollment_status,
                          updated_at::TIMESTAMP AS updated_at)
        FROM raw_students WHERE LENGTH(TRIM(student_id)) > 0""",
    # The best record of a key is the one with the greatest pair; times never tie in these tables.
    "silver_attendance": """
        SELECT best.attendance_id, TRIM(student_id) AS student_id, attendance_date::DATE AS attendance_date,
               best.status, best.created_at
        FROM (SELECT student_id, attendance_date, ARG_MAX(r, (r.status = 'PRESENT', r.created_at)) AS best
              FROM (SELECT student_id, attendance_date,
                           {'attendance_id': attendance_id, 'status': UPPER(TRIM(status)),
                            'created_at': created_at::TIMESTAMP} AS r
                    FROM raw_attendance)
              WHERE r.status IN ('PRESENT', 'ABSENT') GROUP BY ALL)""",
    "silver_assessments": """
        SELECT best.assessment_id, TRIM(student_id) AS student_id, TRIM(subject) AS subject, best.score, best.max_score,
               ROUND(best.score / best.max_score * 100.0, 2) AS normalized_score,
               assessment_date::DATE AS assessment_date, best.created_at
        FROM (SELECT student_id, subject, assessment_date, ARG_MAX(r, r.created_at) AS best
              FROM (SELECT student_id, subject, assessment_date,
                           {'assessment_id': assessment_id, 'score': score::DOUBLE, 'max_score': max_score::DOUBLE,
                            'created_at': created_at::TIMESTAMP} AS r
                    FROM raw_assessments)
              WHERE r.score BETWEEN 0 AND r.max_score GROUP BY ALL)""",
    "enrolled_dim": "SELECT * FROM silver_students WHERE enrollment_status <> 'DROPPED'",
    "class_of": "SELECT MAP(LIST(student_id), LIST(class_id)) AS classes FROM silver_students",
    "fact_attendance": """
        SELECT t.*, classes[t.student_id] AS class_id FROM silver_attendance t, class_of""",
    "fact_assessments": """
        SELECT t.* REPLACE (ROUND(t.score, 2)::DECIMAL(6,2) AS score, ROUND(t.max_score, 2)::DECIMAL(6,2) AS max_score,
                            ROUND(t.normalized_score, 2)::DECIMAL(6,2) AS normalized_score),
               classes[t.student_id] AS class_id
        FROM silver_assessments t, class_of""",
    # Both facts in one table: a status for attendance, a score in cents for assessments.
    "activity": """
        SELECT class_id, attendance_date AS date, student_id, status, NULL AS cents FROM fact_attendance
        UNION ALL
        SELECT class_id, assessment_date, student_id, NULL, (score * 100)::BIGINT FROM fact_assessments""",
    "by_day": """
        SELECT class_id, date, COUNT(DISTINCT student_id) FILTER (status IS NOT NULL) AS students_with_attendance,
               SUM((status IS NOT DISTINCT FROM 'PRESENT')::INT)::BIGINT AS present_count,
               SUM((status IS NOT DISTINCT FROM 'ABSENT')::INT)::BIGINT AS absent_count,
               COUNT(DISTINCT student_id) FILTER (cents IS NOT NULL) AS students_with_assessment,
               COUNT(cents) AS assessment_count,
               COALESCE((2 * SUM(cents)::BIGINT + COUNT(cents)) // NULLIF(2 * COUNT(cents), 0), 0) / 100.0 AS avg_score
        FROM activity GROUP BY class_id, date""",
    "rated": """
        SELECT d.*, n AS total_students, (20000 * present_count + n) // (2 * n) / 10000.0 AS attendance_rate
        FROM by_day d SEMI JOIN silver_students s ON s.class_id = d.class_id AND s.enrollment_status = 'ACTIVE',
        LATERAL (SELECT COUNT(*) AS n FROM silver_students WHERE class_id = d.class_id AND enrollment_status = 'ACTIVE')""",
    "first_by_status": """
        SELECT UNNEST(ARG_MIN(r, (LIST_POSITION(['ABSENT', 'PRESENT'], r.status) IS NULL, r.status <> 'PRESENT',
                                  r.attendance_id)))
        FROM raw_attendance r GROUP BY r.student_id, r.attendance_date""",
    "latest_assessments": """
        SELECT UNNEST(ARG_MAX(r, r.created_at::TIMESTAMP)) FROM raw_assessments r
        GROUP BY r.student_id, r.subject, r.assessment_date""",
}


def _with(sql: str) -> str:
    """Put the definitions that ``sql`` reaches in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in _CTES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(_CTES[name])
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in needed) + "\n" + sql


def _rows(table: str, broken: str) -> str:
    return f"(SELECT COUNT(*) FILTER ({broken}) FROM {table})"


def _repeats(table: str, key: str) -> str:
    """Rows whose key occurs more than once."""
    return f"(SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key}) WHERE n > 1)"


def _rule_rows(table: str, rules: list[tuple[str, str, str, str | None]]) -> str:
    """``seq, rule, expectation, column_name, checked_rows, failed_rows, success`` of a list of rules.

    A rule is (name, expectation, column, broken-row predicate); without a
    predicate it is a uniqueness rule.
    """
    parts = []
    for seq, (name, kind, column, broken) in enumerate(rules):
        failed = _repeats(table, column) if broken is None else _rows(table, broken)
        parts.append(
            f"SELECT {seq} AS seq, '{name}' AS rule, '{kind}' AS expectation, '{column}' AS column_name, "
            f"(SELECT COUNT(*) FROM {table}) AS checked_rows, CAST({failed} AS BIGINT) AS failed_rows"
        )
    union = " UNION ALL ".join(parts)
    return f"SELECT *, failed_rows = 0 AS success FROM ({union})"


_NN = "expect_column_values_to_not_be_null"
_UQ = "expect_column_values_to_be_unique"
_RX = "expect_column_values_to_match_regex"
_IS = "expect_column_values_to_be_in_set"


def _nn(column):
    return (f"{column}_not_null", _NN, column, f"{column} IS NULL")


def _uq(column):
    return (f"{column}_unique", _UQ, column, None)


def _rx(column, pattern):
    return (f"{column}_format", _RX, column, f"NOT regexp_matches({column}, '{pattern}')")


def _is(column, *values):
    listed = ", ".join(f"'{v}'" for v in values)
    return (f"{column}_valid", _IS, column, f"{column} NOT IN ({listed})")


_SID = _rx("student_id", "^S-[0-9]{12,}$")
_ENROLLED = _is("enrollment_status", "ACTIVE", "INACTIVE", "DROPPED", "SUSPENDED")
_STATUS = _is("status", "PRESENT", "ABSENT")
_SUBJECT = _is("subject", "Math", "Science", "English", "History")

_PRIMARY = {
    "students": [
        _nn("student_id"), _uq("student_id"), _SID, _nn("student_name"), _nn("class_id"),
        _rx("class_id", "^CLASS-[0-9]{2}$"), _ENROLLED,
    ],
    "attendance": [
        _nn("attendance_id"), _uq("attendance_id"), _nn("student_id"), _SID, _nn("attendance_date"),
        _nn("status"), _STATUS,
    ],
    "assessments": [
        _nn("assessment_id"), _uq("assessment_id"), _nn("student_id"), _SID, _nn("subject"), _SUBJECT,
        _nn("score"), _nn("max_score"), _nn("assessment_date"),
    ],
}
_FALLBACK = {
    "students": [
        _nn("student_id"), _uq("student_id"), _SID, _nn("class_id"), _is("grade_level", "10", "11", "12"), _ENROLLED,
    ],
    "attendance": [_nn("attendance_id"), _uq("attendance_id"), _nn("student_id"), _nn("attendance_date"), _STATUS],
    "assessments": [
        _nn("assessment_id"), _uq("assessment_id"), _nn("student_id"), _SUBJECT,
        ("score_non_negative", "score_non_negative", "score", "NOT COALESCE(TRY_CAST(score AS DOUBLE) >= 0, FALSE)"),
        ("score_lte_max", "score_lte_max", "score",
         "NOT COALESCE(TRY_CAST(score AS DOUBLE) <= TRY_CAST(max_score AS DOUBLE), FALSE)"),
    ],
}

_ENTITIES = ("students", "attendance", "assessments")


def _suite(entity: str, rules: dict, engine: str, named: str) -> str:
    return (
        f"SELECT '{entity}' AS entity, '{engine}' AS engine, COUNT(*) FILTER (NOT success) = 0 AS success, "
        "COUNT(*) AS evaluated_expectations, COUNT(*) FILTER (NOT success) AS unsuccessful_expectations, "
        f"COALESCE(STRING_AGG({named}, ',' ORDER BY seq) FILTER (NOT success), '') AS failed_expectations "
        f"FROM ({_rule_rows('raw_' + entity, rules[entity])})"
    )


def _verdict(entity: str) -> str:
    return f"(SELECT COUNT(*) FILTER (NOT success) = 0 FROM ({_rule_rows('raw_' + entity, _PRIMARY[entity])}))"


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _kind(column: str) -> str:
    """The narrowest kind of type that all texts of a column have."""
    return f"""CASE COUNT({column}) WHEN COUNT(TRY_CAST({column} AS BIGINT)) THEN 'integer'
                    WHEN COUNT(TRY_CAST({column} AS DOUBLE)) THEN 'double'
                    WHEN COUNT(TRY_CAST({column} AS DATE)) FILTER (LENGTH({column}) = 10) THEN 'date'
                    WHEN COUNT(TRY_CAST({column} AS TIMESTAMP)) THEN 'timestamp' ELSE 'string' END"""


def _typed_columns():
    """(table, column, kind in JSON): there numbers are numbers and all else is text."""
    for table, columns in SOURCE_COLUMNS.items():
        for c in columns:
            yield table, c, "'double'" if c in ("score", "max_score") else "'string'"


def _contract(table: str, source: str, columns: str, rules: list[tuple[str, str, str | None]]) -> str:
    rows = [(name, "", column, broken) for name, column, broken in rules]
    return (
        f"SELECT '{table}' AS table_name, rule, column_name, checked_rows, failed_rows, success "
        f"FROM ({_rule_rows(f'(SELECT {columns} FROM {source})', rows)})"
    )


def _field_rules(table, key, texts, numbers, others, checks=()):
    """Contract rules of a table: key, then per column NOT NULL, value set, length or range."""
    rules = [(f"{table}_key_unique", key, None)]
    rules += [(f"{c}_not_null", c, f"{c} IS NULL") for c in [*texts, *numbers, *others]]
    rules += [(f"{c}_check", c, f"{c} NOT IN ({allowed})") for c, allowed in checks]
    rules += [(f"{c}_length", c, f"LENGTH({c}) > {n}") for c, n in texts.items()]
    rules += [(f"{c}_range", c, f"{c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL") for c, t in numbers.items()]
    return rules


def _contract_violations() -> str:
    stamp = "TIMESTAMP '2025-01-01' AS _ingested_at"
    number = "DECIMAL(6,2)"
    return _union(
        [
            _contract(
                "dim_students", "enrolled_dim", f"*, {stamp}",
                _field_rules(
                    "dim_students", "student_id",
                    {"student_id": 20, "student_name": 100, "class_id": 20, "enrollment_status": 20},
                    {"grade_level": "INTEGER"}, ["updated_at", "_ingested_at"],
                ),
            ),
            _contract(
                "fact_attendance",
                "silver_attendance a LEFT JOIN enrolled_dim s ON a.student_id = s.student_id",
                f"a.*, s.class_id, {stamp}",
                _field_rules(
                    "fact_attendance", "attendance_id",
                    {"attendance_id": 20, "student_id": 20, "class_id": 20, "status": 10},
                    {}, ["attendance_date", "created_at", "_ingested_at"],
                    [("status", "'PRESENT', 'ABSENT'")],
                ),
            ),
            _contract(
                "fact_assessments",
                "silver_assessments a LEFT JOIN enrolled_dim s ON a.student_id = s.student_id",
                f"a.*, s.class_id, {stamp}",
                _field_rules(
                    "fact_assessments", "assessment_id",
                    {"assessment_id": 20, "student_id": 20, "class_id": 20, "subject": 50},
                    {"score": number, "max_score": number, "normalized_score": number},
                    ["assessment_date", "created_at", "_ingested_at"],
                ),
            ),
        ]
    )


_MART_COLUMNS = (
    "class_id, CAST(date AS VARCHAR) AS date, total_students, students_with_attendance, present_count, absent_count, "
    "attendance_rate, students_with_assessment, assessment_count, avg_score"
)
_DIM_TEXT = "student_id, student_name, class_id, grade_level, enrollment_status"


def _counts_of(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS value, COUNT(*) AS value_count "
        f"FROM raw_{table} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


def _distinct_of(table: str, column: str) -> str:
    return f"SELECT DISTINCT '{table}' AS table_name, '{column}' AS column_name, {column} AS value FROM raw_{table}"


def _nulls_of(table: str, columns: list[str]) -> str:
    total = " + ".join(f"COUNT(*) FILTER ({c} IS NULL)" for c in columns)
    return _union(
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, {len(columns)} AS column_count, "
        f"{total} AS table_nulls, '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_count FROM raw_{table}"
        for c in columns
    )


def _duplicates_of(table: str, *keys: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{'+'.join(keys)}' AS key_columns, CAST(SUM(n) AS BIGINT) AS row_count, "
        "CAST(SUM(n - 1) AS BIGINT) AS duplicate_count, "
        "CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_duplicates "
        f"FROM (SELECT COUNT(*) AS n FROM raw_{table} GROUP BY {', '.join(keys)})"
    )


def _mean(column: str = "score") -> str:
    return f"ROUND_EVEN(ROUND_EVEN(AVG(CAST({column} AS DOUBLE)), 10), 6)"


_SOURCE_COLUMNS = {
    "students": ["student_id", "student_name", "class_id", "grade_level", "enrollment_status", "updated_at"],
    "attendance": ["attendance_id", "student_id", "attendance_date", "status", "created_at"],
    "assessments": [
        "assessment_id", "student_id", "subject", "score", "max_score", "assessment_date", "created_at",
    ],
}


def _check(seq: int, name: str, passed: str) -> str:
    return f"SELECT {seq} AS seq, '{name}' AS \"check\", {passed} AS passed"


def _no_nulls(entity: str) -> str:
    anywhere = " OR ".join(f"{c} IS NULL" for c in _SOURCE_COLUMNS[entity])
    return f"(SELECT COUNT(*) = 0 FROM raw_{entity} WHERE {anywhere})"


def _no_orphans(entity: str) -> str:
    return (
        f"(SELECT COUNT(*) = 0 FROM raw_{entity} WHERE student_id IS NULL "
        "OR student_id NOT IN (SELECT student_id FROM raw_students))"
    )


def _describe() -> str:
    x = "CAST(score AS DOUBLE)"
    values = {
        "count": f"CAST(COUNT({x}) AS DOUBLE)",
        "mean": _mean(),
        "std": f"STDDEV_SAMP({x})",
        "min": f"MIN({x})",
        "25%": f"QUANTILE_CONT({x}, 0.25)",
        "50%": f"QUANTILE_CONT({x}, 0.5)",
        "75%": f"QUANTILE_CONT({x}, 0.75)",
        "max": f"MAX({x})",
    }
    return _union(
        f"SELECT '{name}' AS statistic, ROUND_EVEN({value}, 2) AS value FROM raw_assessments"
        for name, value in values.items()
    )


_HISTOGRAM = f"""
    SELECT b.bin, b.lower_edge, b.upper_edge, COUNT(v.x) AS value_count, ANY_VALUE(b.mean) AS overall_mean
    FROM (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / 20.0) + lo AS lower_edge,
                 CASE WHEN i = 19 THEN hi ELSE (i + 1) * ((hi - lo) / 20.0) + lo END AS upper_edge, mean
          FROM (SELECT MIN(CAST(score AS DOUBLE)) AS lo, MAX(CAST(score AS DOUBLE)) AS hi, {_mean()} AS mean
                FROM raw_assessments), RANGE(20) r(i)) b
    LEFT JOIN (SELECT CAST(score AS DOUBLE) AS x FROM raw_assessments) v
      ON v.x >= b.lower_edge AND (v.x < b.upper_edge OR (b.bin = 19 AND v.x = b.upper_edge))
    GROUP BY b.bin, b.lower_edge, b.upper_edge"""


def _build() -> dict[str, str]:
    q: dict[str, str] = {}

    for e in _ENTITIES:
        file = "assessments.json" if e == "assessments" else f"{e}.csv"
        q[f"bronze_{e}"] = (
            f"SELECT *, '2025-01-01T00:00:00' AS _raw_ingested_at, '{file}' AS _source_file FROM raw_{e}"
        )
        q[f"validate_{e}"] = _rule_rows(f"raw_{e}", _PRIMARY[e])
    stamped = {
        "students": f"{_DIM_TEXT}, {_text('updated_at')}, 'students.csv' AS _source",
        "attendance": f"attendance_id, student_id, status, {_text('attendance_date', 'created_at')}, "
        "'attendance.csv' AS _source",
        "assessments": "assessment_id, student_id, subject, score, max_score, normalized_score, "
        f"{_text('assessment_date', 'created_at')}, 'assessments.json' AS _source",
    }
    for e in _ENTITIES:
        q[f"silver_{e}"] = f"SELECT {stamped[e]}, {_verdict(e)} AS _ge_passed FROM silver_{e}"

    q["validate_isolated"] = f"""
        SELECT seq, rule, expectation, column_name, IF(seq = 5, NULL, checked_rows) AS checked_rows,
               IF(seq = 5, NULL, failed_rows) AS failed_rows, seq = 5 OR success AS success,
               IF(seq = 5, 'error', 'primary') AS engine
        FROM ({_rule_rows("raw_students", _PRIMARY["students"])})"""
    q["validate_fallback"] = _union(
        f"SELECT '{e}' AS entity, * FROM ({_rule_rows('raw_' + e, _FALLBACK[e])})" for e in _ENTITIES
    )
    q["suite_results"] = _union(
        [_suite(e, _PRIMARY, "primary", "expectation") for e in _ENTITIES]
        + [_suite(e, _FALLBACK, "fallback", "rule") for e in _ENTITIES]
    )
    q["silver_batch_metrics"] = _union(
        f"SELECT entity, raw_rows AS records_raw, clean_rows AS records_silver, raw_rows - clean_rows AS deduplicated, "
        f"success, failed_expectations FROM (SELECT entity, success, failed_expectations, "
        f"(SELECT COUNT(*) FROM raw_{e}) AS raw_rows, (SELECT COUNT(*) FROM silver_{e}) AS clean_rows "
        f"FROM ({_suite(e, _PRIMARY, 'primary', 'expectation')}))"
        for e in _ENTITIES
    )
    q["rejected_batches"] = _union(
        f"SELECT '{e}' AS entity, COUNT(*) AS rejected_rows FROM raw_{e} WHERE NOT {_verdict(e)}" for e in _ENTITIES
    )
    q["ge_passed_rollup"] = _union(
        f"SELECT '{'assessments.json' if e == 'assessments' else e + '.csv'}' AS _source, {_verdict(e)} AS _ge_passed, "
        f"COUNT(*) AS rows FROM silver_{e}"
        for e in _ENTITIES
    )

    shown = {
        "students": ("student_id", "enrollment_status"),
        "attendance": ("attendance_id", "status"),
        "assessments": ("assessment_id", "subject"),
    }
    q["rejected_rows"] = _union(
        f"SELECT '{e}' AS entity, {record} AS record_id, student_id, {detail} AS detail FROM raw_{e} WHERE NOT {_verdict(e)}"
        for e, (record, detail) in shown.items()
    )
    for e in _ENTITIES:
        file = "assessments.json" if e == "assessments" else f"{e}.csv"
        q[f"landed_{e}"] = q[f"bronze_{e}"]
    q["typed_sources"] = _union(
        f"SELECT '{t}' AS table_name, COUNT({c}) AS filled, MIN({c}) AS least, MAX({c}) AS most FROM raw_{t}"
        for t, c in (("students", "grade_level"), ("assessments", "assessment_id"))
    )

    q["typed_schemas"] = _union(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, '{c}' AS column_name, {_kind(c) if t != 'assessments' else kind} AS kind, "
        f"COUNT(*) - COUNT({c}) AS null_count FROM raw_{t}"
        for t, c, kind in _typed_columns()
    )
    previews = (("students", "student_id", "class_id"), ("attendance", "attendance_id", "status"), ("assessments", "assessment_id", "subject"))
    stamps = (("students", "updated_at"), ("attendance", "created_at"))
    q["profile_previews"] = _union(
        [
            *(
                f"SELECT '{t}' AS table_name, {i} AS record_id, {d} AS detail FROM (SELECT * FROM raw_{t} ORDER BY {i} LIMIT 5)"
                for t, i, d in previews
            ),
            *(
                f"SELECT '{t}', '{c}', v FROM (SELECT DISTINCT {c} AS v FROM raw_{t} ORDER BY v LIMIT 3)"
                for t, c in stamps
            ),
        ]
    )

    q["gold_dim_students"] = f"SELECT {_DIM_TEXT}, {_text('updated_at')} FROM silver_students"
    q["gold_fact_attendance"] = (
        f"SELECT attendance_id, student_id, class_id, status, {_text('attendance_date', 'created_at')} "
        "FROM fact_attendance"
    )
    q["gold_fact_assessments"] = (
        "SELECT assessment_id, student_id, class_id, subject, CAST(score AS DOUBLE) AS score, "
        "CAST(max_score AS DOUBLE) AS max_score, CAST(normalized_score AS DOUBLE) AS normalized_score, "
        f"{_text('assessment_date', 'created_at')} FROM fact_assessments"
    )
    q["contract_violations"] = _contract_violations()
    q["gold_reload_or_keep"] = (
        f"SELECT 'full' AS load, {_DIM_TEXT} FROM silver_students "
        f"UNION ALL SELECT 'empty', {_DIM_TEXT} FROM enrolled_dim"
    )
    q["gold_row_counts"] = _union(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {table}"
        for name, table in {
            "dim_students": "silver_students",
            "fact_attendance": "fact_attendance",
            "fact_assessments": "fact_assessments",
            "mart_class_daily_performance": "rated",
        }.items()
    )

    q["mart_class_students"] = (
        "SELECT class_id, COUNT(*) AS total_students FROM silver_students WHERE enrollment_status = 'ACTIVE' GROUP BY ALL"
    )
    seen = "students_with_attendance, present_count, absent_count"
    q["mart_attendance_agg"] = f"SELECT class_id, {_text('date')}, {seen} FROM by_day WHERE students_with_attendance > 0"
    q["mart_assessment_agg"] = (
        f"SELECT class_id, {_text('date')}, students_with_assessment, assessment_count, avg_score FROM by_day "
        "WHERE assessment_count > 0"
    )
    q["mart_activity_keys"] = f"SELECT DISTINCT class_id, {_text('date')} FROM activity"
    q["mart_class_daily_performance"] = q["mart_full"] = f"SELECT {_MART_COLUMNS} FROM rated"
    q["mart_upsert"] = f"""
        SELECT {_MART_COLUMNS} FROM rated WHERE date >= DATE '{DAY}'
        UNION ALL
        SELECT class_id, date::VARCHAR, total_students, {seen}, attendance_rate, 0, 0, 0.0
        FROM rated WHERE date < DATE '{DAY}' AND students_with_attendance > 0"""
    q["stored_mart_upsert"] = f"SELECT *, IF(date >= '{DAY}', 2, 1) AS loaded_by FROM ({q['mart_upsert']})"
    q["stored_mart_defaults"] = f"""
        SELECT {_MART_COLUMNS.replace('students_with_assessment, assessment_count, avg_score', '')}
               IF(date < DATE '{DAY}', 0, students_with_assessment) AS students_with_assessment,
               IF(date < DATE '{DAY}', 0, assessment_count) AS assessment_count,
               IF(date < DATE '{DAY}', 0.0, avg_score) AS avg_score
        FROM rated"""
    q["stored_mart_head"] = f"SELECT {_MART_COLUMNS} FROM (SELECT * FROM rated ORDER BY date, class_id LIMIT 20)"
    q["gold_load_order"] = _union(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, 0 AS inversions, 0 AS overlaps, "
        f"MIN({key}) AS first_key, MAX({key}) AS last_key FROM {table}"
        for name, table, key in (
            ("dim_students", "silver_students", "student_id"),
            ("fact_attendance", "fact_attendance", "attendance_date::VARCHAR || '|' || student_id"),
            ("fact_assessments", "fact_assessments", "assessment_date::VARCHAR || '|' || student_id"),
        )
    )
    limits = {"default": "LIMIT 25", "named": "LIMIT 40", "all": ""}
    q["report_request_limits"] = _union(
        f"SELECT '{name}' AS request, class_id, date::VARCHAR AS date, present_count "
        f"FROM (SELECT * FROM rated ORDER BY class_id, date {limit})"
        for name, limit in limits.items()
    )
    q["stored_fact_attendance"], q["stored_fact_assessments"] = q["gold_fact_attendance"], q["gold_fact_assessments"]
    q["stored_mart"] = f"SELECT {_MART_COLUMNS}, '2025-01-01 00:00:00' AS _computed_at FROM rated"
    q["mart_ordered_head"] = f"SELECT {_MART_COLUMNS} FROM (SELECT * FROM rated ORDER BY class_id, date LIMIT 20)"

    q["class_avg_attendance"] = """
        SELECT class_id,
               ((2 * CAST(ROUND(SUM(attendance_rate * 10000)) AS BIGINT) + COUNT(*)) // (2 * COUNT(*))) / 100.0
                   AS avg_attendance_pct,
               ((2 * CAST(ROUND(SUM(avg_score * 100)) AS BIGINT) + COUNT(*)) // (2 * COUNT(*))) / 100.0 AS avg_score
        FROM rated GROUP BY class_id"""
    q["lowest_attendance_on_date"] = (
        f"SELECT class_id, {_text('date')}, present_count, total_students, attendance_rate FROM rated "
        f"WHERE date = DATE '{DAY}'"
    )
    q["class_daily_trend"] = (
        f"SELECT {_text('date')}, present_count, absent_count, attendance_rate, avg_score FROM rated "
        "WHERE class_id = 'CLASS-01'"
    )
    q["students_per_class_grade"] = (
        "SELECT class_id, grade_level, COUNT(*) AS students FROM silver_students GROUP BY class_id, grade_level"
    )
    average = "((2 * CAST(SUM(score) * 100 AS BIGINT) + COUNT(*)) // (2 * COUNT(*))) / 100.0"
    q["avg_score_by_subject"] = (
        f"SELECT subject, {average} AS avg_score, COUNT(*) AS assessments FROM fact_assessments GROUP BY subject"
    )
    q["top5_students"] = f"""
        SELECT f.student_id, d.class_id, {average} AS avg_score
        FROM fact_assessments f JOIN silver_students d ON f.student_id = d.student_id
        GROUP BY f.student_id, d.class_id ORDER BY avg_score DESC, f.student_id LIMIT 5"""
    q["attendance_on_date_detail"] = f"""
        SELECT a.student_id, s.student_name, a.class_id, a.status
        FROM fact_attendance a JOIN silver_students s ON a.student_id = s.student_id
        WHERE a.attendance_date = DATE '{DAY}'"""
    q["report_rate_trend"] = f"""
        SELECT {_text('date')}, class_id, "Avg Attendance Rate" FROM (
            SELECT date, class_id, AVG(attendance_rate) AS "Avg Attendance Rate" FROM rated GROUP BY date, class_id
            ORDER BY 3 DESC, date, class_id LIMIT 10000)"""
    q["report_score_by_class"] = """
        SELECT class_id, CAST(SUM(CAST(avg_score AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS "Avg Score"
        FROM rated GROUP BY class_id ORDER BY 2 DESC, class_id LIMIT 50"""
    q["report_present_absent"] = """
        SELECT class_id, CAST(SUM(present_count) AS BIGINT) AS "Present", CAST(SUM(absent_count) AS BIGINT) AS "Absent"
        FROM rated GROUP BY class_id ORDER BY 2 DESC, class_id LIMIT 50"""
    q["report_score_by_subject"] = """
        SELECT subject, CAST(SUM(score) AS DOUBLE) / COUNT(*) AS "Avg Score"
        FROM fact_assessments GROUP BY subject ORDER BY 2 DESC, subject LIMIT 10"""
    q["report_mart_table"] = f"SELECT {_MART_COLUMNS} FROM (SELECT * FROM rated ORDER BY class_id, date LIMIT 500)"

    q["profile_shape_nulls"] = _union(_nulls_of(e, _SOURCE_COLUMNS[e]) for e in _ENTITIES)
    counted = [("students", c) for c in ("enrollment_status", "class_id", "grade_level")]
    counted += [("attendance", "status"), ("assessments", "subject")]
    q["profile_value_counts"] = _union(_counts_of(t, c) for t, c in counted)
    distinct = [("students", c) for c in ("grade_level", "class_id", "updated_at")] + [("assessments", "max_score")]
    q["profile_distinct_values"] = _union(_distinct_of(t, c) for t, c in distinct)
    q["profile_distincts"] = _union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_count FROM raw_{t}"
        for t, c in distinct
    )
    q["profile_date_ranges"] = _union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(MIN(CAST({c} AS DATE)) AS VARCHAR) AS first_date, "
        f"CAST(MAX(CAST({c} AS DATE)) AS VARCHAR) AS last_date FROM raw_{t}"
        for t, c in (("attendance", "attendance_date"), ("assessments", "assessment_date"))
    )
    q["profile_duplicates"] = _union(
        [
            _duplicates_of("students", "student_id"),
            _duplicates_of("attendance", "attendance_id"),
            _duplicates_of("attendance", "student_id", "attendance_date"),
            _duplicates_of("assessments", "assessment_id"),
            _duplicates_of("assessments", "student_id", "subject", "assessment_date"),
        ]
    )
    q["repeated_attendance_rows"] = (
        "SELECT * FROM raw_attendance QUALIFY COUNT(*) OVER (PARTITION BY student_id, attendance_date) > 1"
    )
    q["duplicate_status_signature"] = """
        SELECT statuses, COUNT(*) AS key_count FROM (
            SELECT STRING_AGG(status, '+' ORDER BY status) AS statuses FROM raw_attendance
            GROUP BY student_id, attendance_date HAVING COUNT(*) > 1)
        GROUP BY statuses"""
    q["profile_dedup_effect"] = _union(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {kept}) AS kept_rows, "
        f"(SELECT COUNT(*) FROM raw_{t}) - (SELECT COUNT(*) FROM {kept}) AS removed_rows"
        for t, kept in (("attendance", "first_by_status"), ("assessments", "latest_assessments"))
    )
    q["profile_first_by_status"] = "SELECT * FROM first_by_status"
    q["profile_latest_assessments"] = "SELECT * FROM latest_assessments"
    q["records_per_day"] = (
        "SELECT attendance_date, COUNT(*) AS row_count FROM raw_attendance GROUP BY attendance_date"
    )
    q["score_describe"] = _describe()
    q["score_histogram"] = _HISTOGRAM
    q["subject_mean_desc"] = f"SELECT subject, {_mean()} AS mean_score FROM raw_assessments GROUP BY subject"
    q["class_attendance_rate"] = """
        SELECT c.class_id, c.total_students, COALESCE(p.total_present, 0) AS total_present,
               COALESCE(p.days_recorded, 0) AS days_recorded,
               COALESCE(ROUND_EVEN(CAST(p.total_present AS DOUBLE) / (c.total_students * p.days_recorded), 4), 0.0)
                   AS avg_daily_attendance_rate
        FROM (SELECT class_id, COUNT(student_id) AS total_students FROM raw_students GROUP BY class_id) c
        LEFT JOIN (
            SELECT s.class_id, COUNT(*) FILTER (a.status = 'PRESENT') AS total_present,
                   COUNT(DISTINCT a.attendance_date) AS days_recorded
            FROM first_by_status a JOIN raw_students s ON a.student_id = s.student_id GROUP BY s.class_id) p
        ON c.class_id = p.class_id"""
    q["class_subject_pivot"] = (
        "SELECT s.class_id, "
        + ", ".join(
            f"ROUND_EVEN(ROUND_EVEN(AVG(CAST(a.score AS DOUBLE)) FILTER (a.subject = '{name}'), 6), 2) AS \"{name}\""
            for name in ("Math", "Science", "English", "History")
        )
        + " FROM latest_assessments a JOIN raw_students s ON a.student_id = s.student_id GROUP BY s.class_id"
    )
    q["daily_score_trend"] = f"""
        SELECT assessment_date, mean_score, ROUND_EVEN(ROUND_EVEN(AVG(mean_score) OVER (), 10), 6) AS mean_of_days
        FROM (SELECT assessment_date, {_mean()} AS mean_score FROM latest_assessments GROUP BY assessment_date)"""
    for e, name in (("attendance", "orphan_attendance_rows"), ("assessments", "orphan_assessment_rows")):
        q[name] = f"SELECT * FROM raw_{e} WHERE student_id NOT IN (SELECT student_id FROM enrolled)"
    q["orphan_student_ids"] = _union(
        f"SELECT '{e}' AS table_name, student_id, COUNT(*) AS row_count FROM raw_{e} "
        "WHERE student_id NOT IN (SELECT student_id FROM enrolled) GROUP BY student_id"
        for e in ("attendance", "assessments")
    )
    q["readiness_checklist"] = _union(
        [
            _check(1, "no_nulls_in_students", _no_nulls("students")),
            _check(2, "no_nulls_in_attendance", _no_nulls("attendance")),
            _check(3, "no_nulls_in_assessments", _no_nulls("assessments")),
            _check(
                4,
                "unique_student_ids",
                "(SELECT COUNT(*) = COUNT(DISTINCT student_id) FROM raw_students)",
            ),
            _check(5, "no_orphans_in_attendance", _no_orphans("attendance")),
            _check(6, "no_orphans_in_assessments", _no_orphans("assessments")),
            _check(
                7,
                "known_statuses",
                "(SELECT COUNT(*) = 0 FROM raw_attendance WHERE status NOT IN ('PRESENT', 'ABSENT'))",
            ),
            _check(
                8,
                "scores_within_max",
                "(SELECT COUNT(*) = 0 FROM raw_assessments WHERE CAST(score AS DOUBLE) > CAST(max_score AS DOUBLE))",
            ),
        ]
    )
    return {name: _with(sql) for name, sql in q.items()}


ORACLE_SQL: dict[str, str] = _build()

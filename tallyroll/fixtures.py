"""The three school sources, expressed over the ``customer`` and ``events`` tables.

The SQL is plain enough to run unchanged in other engines. Ids are padded to
twelve digits; longer ones stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STUDENT_ID = "^S-[0-9]{12,}$"

RAW_STUDENTS = """
SELECT CONCAT('S-', CASE WHEN c_custkey < 1000000000000 THEN LPAD(CAST(c_custkey AS STRING), 12, '0')
                           ELSE CAST(c_custkey AS STRING) END) AS student_id,
       CONCAT(' ', c_name, ' ') AS student_name,
       CONCAT('CLASS-', CASE WHEN c_nationkey < 100 THEN LPAD(CAST(c_nationkey AS STRING), 2, '0')
                               ELSE CAST(c_nationkey AS STRING) END) AS class_id,
       CAST(10 + c_custkey % 3 AS STRING) AS grade_level,
       CASE WHEN c_acctbal < 0 THEN 'dropped'
            WHEN c_custkey % 5 = 0 THEN ' active '
            ELSE 'ACTIVE' END AS enrollment_status,
       '2025-01-01 00:00:00' AS updated_at
FROM {customer}
"""

RAW_ATTENDANCE = """
SELECT CONCAT('A-', CAST(event_id AS STRING)) AS attendance_id,
       CONCAT('S-', CASE WHEN user_id < 1000000000000 THEN LPAD(CAST(user_id AS STRING), 12, '0')
                           ELSE CAST(user_id AS STRING) END) AS student_id,
       CAST(CAST(ts AS DATE) AS STRING) AS attendance_date,
       CASE event_type WHEN 'view' THEN 'present '
                       WHEN 'click' THEN 'PRESENT'
                       WHEN 'error' THEN 'ABSENT'
                       ELSE 'UNKNOWN' END AS status,
       CAST(ts AS STRING) AS created_at
FROM {events}
WHERE event_type <> 'purchase'
"""

RAW_ASSESSMENTS = """
SELECT CONCAT('E-', CAST(event_id AS STRING)) AS assessment_id,
       CONCAT('S-', CASE WHEN user_id < 1000000000000 THEN LPAD(CAST(user_id AS STRING), 12, '0')
                           ELSE CAST(user_id AS STRING) END) AS student_id,
       CASE event_id % 4 WHEN 0 THEN 'Math'
                         WHEN 1 THEN 'Science'
                         WHEN 2 THEN 'English'
                         ELSE 'History' END AS subject,
       CAST(value AS STRING) AS score,
       '100.0' AS max_score,
       CAST(CAST(ts AS DATE) AS STRING) AS assessment_date,
       CAST(ts AS STRING) AS created_at
FROM {events}
WHERE event_type IN ('purchase', 'signup')
"""

SOURCES = {"students": RAW_STUDENTS, "attendance": RAW_ATTENDANCE, "assessments": RAW_ASSESSMENTS}


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    table = "customer" if entity == "students" else "events"
    return spark.sql(SOURCES[entity], **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def enrolled_students(students: DataFrame) -> DataFrame:
    """The students that have not dropped out: against them some records are orphans."""
    return students.where("upper(trim(enrollment_status)) <> 'DROPPED'")

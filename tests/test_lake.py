"""Files, batch folders, Gold versions and the whole run."""

import json
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyroll import fixtures
from tallyroll.plans import profiling
from tallyroll.plans.gold import typed, with_defaults
from tallyroll.plans.profiling import file_order, inferred_schema, load_order
from tallyroll.plans.runner import Pipeline
from tallyroll.queries import QUERIES
from tallyroll.schemas import CONTRACTS, DIM_STUDENTS, FACT_ATTENDANCE, MART, SOURCE_COLUMNS, UTC_NOW
from tallyroll.sources.files import (
    MissingColumn,
    read_csv_text,
    read_csv_typed,
    read_json_text,
    read_json_typed,
    with_audit,
)
from tallyroll.sources.lake import ContractViolation, Lake

DAY = "2025-01-01"


# --- files --------------------------------------------------------------------
def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_csv_cells_stay_text(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'c,a,b\ny,x,\n"1,5","q""z",NA\n\n" s ",007,\'\n')
    df = read_csv_text(spark, path, ["a", "b"])
    assert [tuple(r) for r in df.select("a", "b", "c").collect()] == [
        ("x", "", "y"),
        ('q"z', "NA", "1,5"),
        ("007", "'", " s "),
    ]
    assert set(dict(df.dtypes).values()) == {"string"}
    with pytest.raises(MissingColumn, match="d"):
        read_csv_text(spark, path, ["a", "d"])


def test_csv_with_line_breaks_is_refused_or_read_whole(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'a,b\n"one\ntwo",x\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv_text(spark, path).collect()
    assert [tuple(r) for r in read_csv_text(spark, path, multiline=True).collect()] == [("one\ntwo", "x")]


def test_json_values_become_text(spark, tmp_path):
    text = '[{"a": null, "b": 85.50, "c": true, "x": 1},\n {"b": "7", "c": "NA"}]'
    path = write(tmp_path, "a.json", text)
    df = read_json_text(spark, path, ["a", "b", "c"])
    assert [tuple(r) for r in df.collect()] == [(None, "85.50", "true"), (None, "7", "NA")]
    assert set(read_json_text(spark, path).columns) == {"a", "b", "c", "x"}
    lines = write(tmp_path, "b.json", '{"a": "1"}\n{"a": 2}\n')
    assert [r.a for r in read_json_text(spark, lines, ["a"], json_lines=True).collect()] == ["1", "2"]


def test_typed_reads(spark, tmp_path):
    csv = read_csv_typed(spark, write(tmp_path, "a.csv", "a,b\n1,\n2,x\n"))
    assert dict(csv.dtypes)["a"] == "int" and csv.where("b is null").count() == 1
    assert dict(read_json_typed(spark, write(tmp_path, "a.json", '[{"a": 1.5}]')).dtypes) == {"a": "double"}


def test_audit_columns(spark):
    row = with_audit(spark.range(1), "students.csv", datetime(2025, 1, 2, 3, 4, 5, 6)).first()
    assert (row._raw_ingested_at, row._source_file) == ("2025-01-02T03:04:05.000006", "students.csv")


# --- batches and tables ---------------------------------------------------------
def test_a_batch_is_replaced_even_by_an_empty_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.write_batch(spark.range(5), "bronze", "students", DAY) == 5
    assert lake.write_batch(spark.range(2), "bronze", "students", "2025-01-02") == 2
    assert lake.write_batch(spark.range(0), "bronze", "students", DAY) == 0
    assert lake.read_batch("bronze", "students", DAY).count() == 0
    assert lake.read_batch("bronze", "students", "2025-01-02").count() == 2


def student(key, class_id="CLASS-01", name="Ann"):
    return (key, name, class_id, 10, "ACTIVE", datetime(2025, 1, 1), datetime(2025, 1, 1))


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM_STUDENTS.schema)


def ids(lake):
    return sorted(r.student_id for r in lake.read_table("dim_students").collect())


def test_reload_publishes_only_accepted_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.live_version("dim_students") is None
    assert lake.read_table("dim_students").columns == DIM_STUDENTS.columns and ids(lake) == []
    with pytest.raises(LookupError):
        lake.read_table("dim_teachers")
    assert lake.replace_table(dim(spark, student("S-1"), student("S-2")), DIM_STUDENTS) == 2

    with pytest.raises(ContractViolation) as repeated:
        lake.replace_table(dim(spark, student("S-3"), student("S-3")), DIM_STUDENTS)
    assert repeated.value.broken == {"dim_students_key_unique": 2}
    with pytest.raises(ContractViolation) as broken:
        lake.replace_table(dim(spark, student("S-3", None), student("S-4", name="x" * 101)), DIM_STUDENTS)
    assert broken.value.broken == {"class_id_not_null": 1, "student_name_length": 1}
    assert lake.replace_table(dim(spark), DIM_STUDENTS) == 0
    assert ids(lake) == ["S-1", "S-2"]

    lake.replace_table(dim(spark, student("S-5")), DIM_STUDENTS)
    lake.replace_table(dim(spark, student("S-6")), DIM_STUDENTS)
    assert ids(lake) == ["S-6"]
    assert len(lake.drop_old_versions("dim_students", keep=1)) == 2
    assert ids(lake) == ["S-6"]


def test_left_out_columns_take_their_default(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.createDataFrame([("CLASS-01", "2024-01-01", 3)], "class_id string, date string, total_students int")
    lake.replace_table(rows, MART)
    row = lake.read_table(MART.table).first()
    assert (row.present_count, row.avg_score, row.attendance_rate) == (0, 0, None)
    assert row._computed_at is not None


def test_number_out_of_range_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([("C", "2024-01-01", 1, 12.5)], "class_id string, date string, total_students int, attendance_rate double")
    with pytest.raises(ContractViolation, match="attendance_rate_range"):
        Lake(spark, str(tmp_path)).replace_table(rows, MART)


def test_upsert_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.upsert_table(dim(spark, student("S-1"), student("S-2")), DIM_STUDENTS) == 2
    assert lake.upsert_table(dim(spark, student("S-2", name="New"), student("S-3")), DIM_STUDENTS) == 2
    assert lake.upsert_table(dim(spark), DIM_STUDENTS) == 0
    names = {r.student_id: r.student_name for r in lake.read_table("dim_students").collect()}
    assert names == {"S-1": "Ann", "S-2": "New", "S-3": "Ann"}
    with pytest.raises(ContractViolation, match="repeated"):
        lake.upsert_table(dim(spark, student("S-9"), student("S-9")), DIM_STUDENTS)
    assert ids(lake) == ["S-1", "S-2", "S-3"]


def mart_of(spark, *rows):
    """Mart rows from (class, day, present)."""
    return spark.createDataFrame(list(rows), "class_id string, date string, present_count int").withColumn("date", F.col("date").cast("date"))


def day_files(lake):
    return {f: sorted(p.name for p in (Path(lake.table_path(MART.table)) / f).glob("*.parquet")) for f in lake.describe(MART.table).folders}


def test_a_merge_writes_only_its_own_days(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    assert lake.upsert_table(mart_of(spark, *((c, d, 1) for c in "AB" for d in days)), MART) == 20
    before = day_files(lake)
    assert lake.upsert_table(mart_of(spark, ("A", days[4], 7), ("C", days[4], 8), ("A", "2024-02-01", 9)), MART) == 3
    after = day_files(lake)
    unchanged = {f for f in before if not f.endswith(days[4])}
    assert {f: after[f] for f in unchanged} == {f: before[f] for f in unchanged}
    assert set(after) - set(before) == {"v=000002/date=2024-01-05", "v=000002/date=2024-02-01"}
    rows = {(r.class_id, str(r.date)): r.present_count for r in lake.read_table(MART.table).collect()}
    assert len(rows) == 22 and rows["A", days[4]] == 7 and rows["B", days[4]] == 1 and rows["C", days[4]] == 8
    assert lake.describe(MART.table).folders["v=000002/date=2024-01-05"] == 3
    # Only the folders of a day that is asked for are read.
    asked = lake.read_table(MART.table).where("date = date'2024-01-05'")
    assert asked.count() == 3 and "PartitionFilters: [isnotnull(date" in asked._jdf.queryExecution().toString()


def test_old_versions_leave_the_days_still_used(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for present, days in enumerate((("01", "02", "03"), ("02",), ("03",), ("03",))):
        lake.upsert_table(mart_of(spark, *(("A", f"2024-01-{d}", present) for d in days)), MART)
    assert lake.drop_old_versions(MART.table, keep=1) == [1, 2, 3]
    left = sorted(str(p.relative_to(lake.table_path(MART.table))) for p in Path(lake.table_path(MART.table)).glob("v=*/date=*"))
    assert left == ["v=000001/date=2024-01-01", "v=000002/date=2024-01-02", "v=000004/date=2024-01-03"]
    assert sorted((str(r.date), r.present_count) for r in lake.read_table(MART.table).collect()) == [
        ("2024-01-01", 0), ("2024-01-02", 1), ("2024-01-03", 3),
    ]
    lake.upsert_table(mart_of(spark, *(("A", f"2024-01-{d}", 9) for d in ("01", "02", "03"))), MART)
    lake.drop_old_versions(MART.table, keep=1)
    assert [p.name for p in Path(lake.table_path(MART.table)).glob("v=*")] == ["v=000005"]


def test_a_refused_merge_changes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.upsert_table(mart_of(spark, ("A", "2024-01-01", 1)), MART)
    with pytest.raises(ContractViolation, match="class_id_length"):
        lake.upsert_table(mart_of(spark, ("A" * 21, "2024-01-01", 2)), MART)
    with pytest.raises(ContractViolation, match="date_not_null"):
        lake.upsert_table(mart_of(spark, ("A", None, 2)), MART)
    assert [r.present_count for r in lake.read_table(MART.table).collect()] == [1]
    assert lake.live_version(MART.table) == 1 and len(list(Path(lake.table_path(MART.table)).glob("v=*"))) == 1


def test_a_load_killed_before_its_marker_is_not_seen(spark, tmp_path, monkeypatch):
    """Whatever step is the last one, readers get the rows of before."""
    lake = Lake(spark, str(tmp_path))
    lake.write_batch(spark.range(5), "silver", "students", DAY)
    lake.upsert_table(mart_of(spark, ("A", "2024-01-01", 1)), MART)

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed

    for step in ("_publish", "_remove"):  # with _remove gone too, nothing is cleaned up, as after a kill
        monkeypatch.setattr(Lake, step, killed)
        with pytest.raises(Killed):
            lake.write_batch(spark.range(9), "silver", "students", DAY)
        with pytest.raises(Killed):
            lake.upsert_table(mart_of(spark, ("A", "2024-01-01", 2), ("B", "2024-01-02", 2)), MART)
        assert lake.read_batch("silver", "students", DAY).count() == 5
        assert [r.present_count for r in lake.read_table(MART.table).collect()] == [1]
    monkeypatch.undo()
    assert lake.write_batch(spark.range(9), "silver", "students", DAY) == 9
    lake.upsert_table(mart_of(spark, ("B", "2024-01-02", 3)), MART)
    assert lake.read_batch("silver", "students", DAY).count() == 9
    assert sorted(r.present_count for r in lake.read_table(MART.table).collect()) == [1, 3]


def test_reruns_keep_one_batch_behind_the_live_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for n in (1, 2, 3, 4):
        lake.write_batch(spark.range(n), "bronze", "students", DAY)
    assert sorted(p.name for p in Path(lake.batch_path("bronze", "students", DAY)).glob("v=*")) == ["v=000003", "v=000004"]
    assert lake.read_batch("bronze", "students", DAY).count() == 4
    with pytest.raises(LookupError):
        lake.read_batch("bronze", "students", "1999-01-01")


def test_files_from_before_a_column_have_its_default(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    added = ("assessment_count", "avg_score", "_computed_at")
    before = replace(MART, fields=tuple(f for f in MART.fields if f.name not in added))
    lake.replace_table(mart_of(spark, ("A", "2024-01-01", 1), ("A", "2024-01-02", 1)), before)
    lake.upsert_table(mart_of(spark, ("A", "2024-01-02", 2), ("A", "2024-01-03", 2)).withColumn("assessment_count", F.lit(4)), MART)
    rows = {str(r.date): r for r in lake.read_table(MART.table).collect()}
    assert [(rows[d].assessment_count, str(rows[d].avg_score), rows[d].present_count) for d in sorted(rows)] == [
        (0, "0.00", 1), (4, "0.00", 2), (4, "0.00", 2),
    ]
    # A default of the time is taken once, when the column comes to the table.
    stamp = rows["2024-01-01"]["_computed_at"]
    assert stamp is not None and {r["_computed_at"] for r in lake.read_table(MART.table).where("date = '2024-01-01'").collect()} == {stamp}


def test_a_head_reads_the_first_days_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.table_head(MART.table, 3, ["date", "class_id"]).collect() == []
    lake.upsert_table(mart_of(spark, *((c, f"2024-01-{d:02d}", d) for c in "BA" for d in range(1, 20))), MART)
    lake.upsert_table(mart_of(spark, ("C", "2024-01-02", 0)), MART)
    head = lake.table_head(MART.table, 4, ["date", "class_id"])
    assert [(r.class_id, r.date.day) for r in head.collect()] == [("A", 1), ("B", 1), ("A", 2), ("B", 2)]
    assert len(head.inputFiles()) == 2 < len(lake.read_table(MART.table).inputFiles())
    with pytest.raises(ValueError):
        lake.table_head(MART.table, 4, ["class_id"])


def test_disorder_in_files_is_counted(spark, tmp_path):
    for name, ids in (("a", [1, 2, 3, 3, 9]), ("b", [5, 4, 6, 2])):
        spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.parquet(str(tmp_path / "t" / name))
    stored = spark.read.parquet(str(tmp_path / "t" / "a"), str(tmp_path / "t" / "b"))
    files = [r[1:3] + (r.first_key.id, r.last_key.id, r.overlaps) for r in file_order(stored, ["id"]).orderBy("row_count").collect()]
    assert files == [(4, 2, 5, 2, True), (5, 0, 1, 9, False)]
    assert tuple(load_order(stored, "t", ["id"]).first()) == ("t", 9, 2, 1, "1", "9")
    empty = load_order(stored.where("id > 99"), "t", ["id"]).first()
    assert tuple(empty)[:4] == ("t", 0, 0, 0)


def test_types_agree_with_the_sniffing_of_another_engine(spark, tmp_path, sf_dir):
    """Kinds that Spark infers from files, and those that DuckDB finds in the same files."""
    kinds = {"BIGINT": "integer", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp", "VARCHAR": "string"}
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True}
    for entity in ("students", "attendance"):
        fixtures.raw(spark, sf_dir, entity).coalesce(1).write.options(**plain).csv(f"{tmp_path}/{entity}")
        found = {r.column_name: r.kind for r in inferred_schema(read_csv_typed(spark, f"{tmp_path}/{entity}"), entity).collect()}
        sniffed = duckdb.sql(f"DESCRIBE SELECT * FROM read_csv('{tmp_path}/{entity}/*.csv', sample_size = -1)").fetchall()
        assert found == {c: kinds[t] for c, t, *_ in sniffed}
    numbers = fixtures.raw(spark, sf_dir, "assessments").selectExpr("* except (score)", "cast(score as double) as score")
    numbers.coalesce(1).write.json(f"{tmp_path}/a")
    found = {r.column_name: r.kind for r in inferred_schema(read_json_typed(spark, f"{tmp_path}/a", json_lines=True), "a").collect()}
    sniffed = duckdb.sql(f"DESCRIBE SELECT * FROM read_json('{tmp_path}/a/*.json', sample_size = -1)").fetchall()
    assert {c: found[c] for c in ("score", "subject", "assessment_id")} == {c: kinds[t] for c, t, *_ in sniffed if c in ("score", "subject", "assessment_id")}


# --- the whole run ----------------------------------------------------------------
STUDENTS = [
    ["S-0001", "Ann", "CLASS-01", "10", "ACTIVE", "2025-01-01 00:00:00"],
    ["S-0002", "Bob", "CLASS-01", "11", "ACTIVE", "2025-01-01 00:00:00"],
    ["S-0003", "Cid", "CLASS-02", "12", "DROPPED", "2025-01-01 00:00:00"],
]
ATTENDANCE = [
    ["A1", "S-0001", "2025-01-10", "ABSENT", "2025-01-10 08:00:00"],
    ["A2", "S-0001", "2025-01-10", "PRESENT", "2025-01-10 07:00:00"],
    ["A3", "S-0002", "2025-01-10", "ABSENT", "2025-01-10 08:00:00"],
    ["A4", "S-0003", "2025-01-10", "PRESENT", "2025-01-10 08:00:00"],
]
ASSESSMENTS = [
    ["E1", "S-0001", "Math", 80, 100, "2025-01-10", "2025-01-10 08:00:00"],
    ["E2", "S-0001", "Math", 90.5, 100, "2025-01-10", "2025-01-10 09:00:00"],
    ["E3", "S-0002", "History", 70, 100, "2025-01-11", "2025-01-11 09:00:00"],
]


def sources(folder, attendance=ATTENDANCE, assessments=ASSESSMENTS, students=STUDENTS):
    for name, rows in (("students", students), ("attendance", attendance)):
        lines = [",".join(SOURCE_COLUMNS[name])] + [",".join(r) for r in rows]
        write(folder, f"{name}.csv", "\n".join(lines) + "\n")
    objects = [dict(zip(SOURCE_COLUMNS["assessments"], r)) for r in assessments]
    write(folder, "assessments.json", json.dumps(objects))
    return str(folder)


def mart_rows(pipeline):
    rows = pipeline.lake.read_table(MART.table).orderBy("class_id", "date").collect()
    return [(r.class_id, str(r.date), r.present_count, float(r.attendance_rate), float(r.avg_score)) for r in rows]


def test_whole_run(spark, tmp_path):
    pipeline = Pipeline(spark, sources(tmp_path / "in"), str(tmp_path / "lake"))
    result = pipeline.run(DAY)
    silver = result["silver"]
    assert [(s["records_raw"], s["records_silver"], s["deduplicated"]) for s in silver.values()] == [
        (3, 3, 0),
        (4, 3, 1),
        (3, 2, 1),
    ]
    assert all(s["validation"]["success"] for s in silver.values())
    assert not (tmp_path / "lake" / "rejected").exists()
    assert result["gold"] == {
        "dim_students": 3,
        "fact_attendance": 3,
        "fact_assessments": 2,
        "mart_class_daily_performance": 2,
    }
    assert mart_rows(pipeline) == [
        ("CLASS-01", "2025-01-10", 1, 0.5, 90.5),
        ("CLASS-01", "2025-01-11", 0, 0.0, 70.0),
    ]
    bronze = pipeline.lake.read_batch("bronze", "assessments", DAY)
    assert sorted(r.score for r in bronze.collect()) == ["70", "80", "90.5"]
    summary = pipeline.silver_summary(silver).collect()
    assert [(r.entity, r.deduplicated, r.engine) for r in summary][1] == ("attendance", 1, "primary")
    assert pipeline.gold_summary(result["gold"]).count() == 4

    # The next run brings one new day; days it does not mention stay in the mart.
    later = [["A9", "S-0002", "2025-01-12", "PRESENT", "2025-01-12 08:00:00"]]
    sources(tmp_path / "in", attendance=later, assessments=ASSESSMENTS[2:])
    pipeline.run("2025-01-02")
    assert mart_rows(pipeline) == [
        ("CLASS-01", "2025-01-10", 1, 0.5, 90.5),
        ("CLASS-01", "2025-01-11", 0, 0.0, 70.0),
        ("CLASS-01", "2025-01-12", 1, 0.5, 0.0),
    ]

    pipeline.run("2025-01-03")
    assert len(list((tmp_path / "lake" / "gold" / MART.table).glob("v=*/_LIVE"))) == 2

    views = pipeline.lake.register_views(DAY)
    assert "mart_class_daily_performance" in views and "silver_students" in views
    graded = spark.sql("SELECT grade_level, max(score) AS best FROM fact_assessments JOIN dim_students USING (student_id) GROUP BY ALL")
    assert [(r.grade_level, float(r.best)) for r in graded.collect()] == [(11, 70.0)]


def test_profiles_of_typed_files(spark, tmp_path):
    folder = sources(tmp_path / "in", students=STUDENTS + [["S-0004", "", "CLASS-02", "12", "ACTIVE", "2025-01-01 00:00:00"]])
    tables = {
        "students": read_csv_typed(spark, f"{folder}/students.csv"),
        "attendance": read_csv_typed(spark, f"{folder}/attendance.csv"),
        "assessments": read_json_typed(spark, f"{folder}/assessments.json"),
    }
    passed = {r.seq: r.passed for r in profiling.readiness(tables).collect()}
    assert passed == {i: i != 1 for i in range(1, 9)}  # only the empty name is a NULL
    nulls = {r.column_name: r.null_count for r in profiling.shape_and_nulls(tables["students"], "students").collect()}
    assert nulls["student_name"] == 1 and sum(nulls.values()) == 1
    span = profiling.date_range(tables["attendance"], "attendance", "attendance_date").first()
    assert str(span.first_date) == str(span.last_date) == "2025-01-10"
    described = {r.statistic: r.value for r in profiling.score_description(tables["assessments"]).collect()}
    assert described == {
        "count": 3, "mean": 80.17, "std": 10.25, "min": 70.0, "25%": 75.0, "50%": 80.0, "75%": 85.25, "max": 90.5,
    }
    daily = profiling.daily_means(tables["assessments"]).collect()
    assert [(str(r.assessment_date), r.mean_score) for r in daily] == [("2025-01-10", 90.5), ("2025-01-11", 70.0)]


def test_a_source_without_rows_leaves_its_table_as_it_was(spark, tmp_path):
    pipeline = Pipeline(spark, sources(tmp_path / "in", attendance=[]), str(tmp_path / "lake"))
    result = pipeline.run(DAY)
    assert result["silver"]["attendance"]["validation"]["success"] is True
    assert result["silver"]["attendance"]["records_silver"] == 0
    assert result["gold"]["fact_attendance"] == 0
    expected = [("CLASS-01", "2025-01-10", 0, 0.0, 90.5), ("CLASS-01", "2025-01-11", 0, 0.0, 70.0)]
    assert mart_rows(pipeline) == expected

    sources(tmp_path / "in")
    pipeline.ingest_attendance(DAY)
    pipeline.transform_attendance(DAY)
    assert pipeline.load_fact_attendance(DAY) == 3
    sources(tmp_path / "in", attendance=[])
    assert pipeline.run("2025-01-02")["gold"]["fact_attendance"] == 0
    assert pipeline.lake.read_table("fact_attendance").count() == 3
    assert mart_rows(pipeline)[0] == ("CLASS-01", "2025-01-10", 1, 0.5, 90.5)


def test_failed_validation_quarantines_and_continues(spark, tmp_path):
    bad = ATTENDANCE + [["A5", "S-0002", "2025-01-11", "late", "2025-01-11 08:00:00"]]
    pipeline = Pipeline(spark, sources(tmp_path / "in", attendance=bad), str(tmp_path / "lake"))
    result = pipeline.run(DAY)["silver"]["attendance"]
    assert result["validation"]["success"] is False
    assert (result["records_raw"], result["records_silver"]) == (5, 3)
    rejected = pipeline.lake.read_batch("rejected", "attendance", DAY)
    bronze = pipeline.lake.read_batch("bronze", "attendance", DAY)
    assert rejected.count() == 5 and rejected.exceptAll(bronze).isEmpty()
    stamped = pipeline.lake.read_batch("silver", "attendance", DAY)
    assert {r._ge_passed for r in stamped.collect()} == {False}
    assert pipeline.lake.read_table("fact_attendance").count() == 3


def test_an_orphan_stops_the_load(spark, tmp_path):
    orphan = ATTENDANCE + [["A6", "S-0099", "2025-01-11", "ABSENT", "2025-01-11 08:00:00"]]
    pipeline = Pipeline(spark, sources(tmp_path / "in", attendance=orphan), str(tmp_path / "lake"))
    with pytest.raises(ContractViolation) as stopped:
        pipeline.run(DAY)
    assert stopped.value.broken == {"class_id_not_null": 1}
    assert pipeline.lake.live_version(FACT_ATTENDANCE.table) is None
    assert pipeline.lake.live_version(DIM_STUDENTS.table) == 1


def test_absent_json_key_stops_before_silver(spark, tmp_path):
    folder = sources(tmp_path / "in")
    pipeline = Pipeline(spark, folder, str(tmp_path / "lake"))
    pipeline.ingest("assessments", DAY)
    before = sorted(map(tuple, pipeline.lake.read_batch("bronze", "assessments", DAY).collect()))
    write(tmp_path / "in", "assessments.json", json.dumps([{"assessment_id": "E1", "student_id": "S-0001"}]))
    with pytest.raises(MissingColumn, match="subject"):
        pipeline.ingest("assessments", DAY)
    assert sorted(map(tuple, pipeline.lake.read_batch("bronze", "assessments", DAY).collect())) == before
    assert list((tmp_path / "lake" / "_aside").glob("*")) == []

    # A key that is there, but null in every record, is data.
    rows = [dict(zip(SOURCE_COLUMNS["assessments"], [*r[:2], None, *r[3:]])) for r in ASSESSMENTS]
    write(tmp_path / "in", "assessments.json", json.dumps(rows))
    pipeline.ingest("assessments", DAY)
    assert {r.subject for r in pipeline.lake.read_batch("bronze", "assessments", DAY).collect()} == {None}


def test_a_failing_rerun_leaves_the_batch(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_batch(spark.range(5), "silver", "students", DAY)
    with pytest.raises(Exception, match="boom"):
        lake.write_batch(spark.range(9).selectExpr("if(id = 8, raise_error('boom'), id) as id"), "silver", "students", DAY)
    assert lake.read_batch("silver", "students", DAY).count() == 5
    with pytest.raises(Exception, match="boom"):
        lake.upsert_table(dim(spark, student("S-1")).selectExpr("* except (class_id)", "raise_error('boom') as class_id"), DIM_STUDENTS)
    assert list((tmp_path / "_aside").glob("*")) == []


def test_gold_files_hold_few_days(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(3000).selectExpr(
        "concat('A', id) as attendance_id", "concat('S', id % 100) as student_id", "'C' as class_id",
        "date_add(date'2024-01-01', cast(id * 7919 % 30 as int)) as attendance_date", "'PRESENT' as status",
        "timestamp_ntz'2024-01-01 00:00:00' as created_at",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert lake.replace_table(rows.repartition(6), FACT_ATTENDANCE) == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = lake.read_table(FACT_ATTENDANCE.table).groupBy(F.col("_metadata.file_path")).agg(
        F.min("attendance_date").alias("low"), F.max("attendance_date").alias("high")
    )
    spans = sorted((r.low, r.high) for r in files.collect())
    assert len(spans) > 4
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_stamps_are_utc_and_casts_strict(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = spark.range(1).select(F.expr(UTC_NOW).alias("t")).first().t
        assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - stamp).total_seconds()) < 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    wide = spark.createDataFrame([("C", 123456.0)], "class_id string, avg_score double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        typed(with_defaults(wide, MART).withColumn("date", F.lit("2024-01-01")), MART).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            Pipeline(spark, str(tmp_path), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_gold_types(spark, tmp_path):
    pipeline = Pipeline(spark, sources(tmp_path / "in"), str(tmp_path / "lake"))
    pipeline.run(DAY)
    for contract in CONTRACTS.values():
        assert pipeline.lake.read_table(contract.table).dtypes == [(f.name, f.type) for f in contract.fields]


def test_fallback_engine_and_own_patterns(spark, tmp_path):
    longer = [[r[0].replace("S-", "S-00"), *r[1:]] for r in STUDENTS]
    folder = sources(tmp_path / "in", students=longer)
    default = Pipeline(spark, folder, str(tmp_path / "a"), engine="fallback")
    default.ingest("students", DAY)
    assert default.transform("students", DAY)["validation"]["failed_expectations"] == ["student_id_format"]
    own = Pipeline(spark, folder, str(tmp_path / "b"), patterns={"student_id": "^S-[0-9]{6}$"})
    own.ingest("students", DAY)
    assert own.transform("students", DAY)["validation"]["success"] is True


def test_run_over_files_of_the_given_tables(spark, sf_dir, tmp_path):
    """The tables written out as source files, run through every layer, give the mart of the direct query."""
    folder = str(tmp_path / "in")
    for entity in ("students", "attendance"):
        raw = fixtures.raw(spark, sf_dir, entity).repartition(4).write.option("header", True)
        raw.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{entity}.csv")
    fixtures.raw(spark, sf_dir, "assessments").repartition(4).write.json(f"{folder}/assessments.json")

    pipeline = Pipeline(
        spark, folder, str(tmp_path / "lake"), patterns={"student_id": fixtures.STUDENT_ID}, json_lines=True
    )
    result = pipeline.run(DAY)
    counts = {e: (r["records_raw"], r["records_silver"], r["validation"]["success"]) for e, r in result["silver"].items()}
    assert counts == {
        "students": (1500, 1500, False),
        "attendance": (8019, 3288, False),
        "assessments": (3998, 3190, True),
    }
    loaded = pipeline.lake.read_table(MART.table).drop("_computed_at")
    text = [f"cast({c} as string) as {c}" for c in loaded.columns]
    direct = QUERIES["mart_class_daily_performance"](spark, sf_dir)
    numbers = [f"cast({c} as double) as {c}" for c in loaded.columns if c not in ("class_id", "date")]
    assert loaded.count() == direct.count() == 750
    assert (
        loaded.selectExpr("class_id", text[1], *numbers)
        .exceptAll(direct.selectExpr("class_id", "date", *numbers))
        .isEmpty()
    )

"""Every query of the package over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime
from functools import cached_property, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from tallyroll import fixtures
from tallyroll.operators.lookup import orphan_keys, orphan_rows
from tallyroll.operators.merge import reload_or_keep, upsert
from tallyroll.plans import gold, mart, profiling, quality, reports
from tallyroll.plans.runner import Pipeline
from tallyroll.plans.silver import SILVER
from tallyroll.schemas import (
    CONTRACTS,
    DIM_STUDENTS,
    ENTITIES,
    FACT_ASSESSMENTS,
    FACT_ATTENDANCE,
    MART,
    SOURCE_FILES,
    Contract,
)
from tallyroll.session import new_folder
from tallyroll.sources.files import read_csv_typed, read_json_typed, with_audit
from tallyroll.sources.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-10"
CLASS = "CLASS-01"
LANDED_AT = datetime(2025, 1, 1)
RUN_DATE = "2025-01-01"

QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and decimals as doubles: clients differ on these types."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DateType, TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


class _Tables:
    """The layers over one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def raw(self, entity: str) -> DataFrame:
        if entity not in self._raw:
            self._raw[entity] = fixtures.raw(self.spark, self.sf_dir, entity)
        return self._raw[entity]

    def rules(self, entity: str) -> list[quality.Rule]:
        return quality.primary_suite(entity, student_id=fixtures.STUDENT_ID)

    def silver(self, entity: str) -> DataFrame:
        if entity not in self._silver:
            self._silver[entity] = SILVER[entity](self.raw(entity))
        return self._silver[entity]

    def judged_silver(self, entity: str) -> DataFrame:
        raw = self.raw(entity)
        return SILVER[entity](raw, quality.passed(raw, self.rules(entity)))

    @cached_property
    def dim(self) -> DataFrame:
        return gold.typed(gold.dim_students(self.silver("students")), DIM_STUDENTS)

    @cached_property
    def attendance(self) -> DataFrame:
        fact = gold.fact_attendance(self.silver("attendance"), self.silver("students"))
        return gold.typed(fact, FACT_ATTENDANCE)

    @cached_property
    def assessments(self) -> DataFrame:
        fact = gold.fact_assessments(self.silver("assessments"), self.silver("students"))
        return gold.typed(fact, FACT_ASSESSMENTS)

    @cached_property
    def mart(self) -> DataFrame:
        return mart.class_daily_performance(self.dim, self.attendance, self.assessments)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- Bronze -----------------------------------------------------------------
def _bronze(entity: str) -> Query:
    def run(spark, sf_dir):
        return with_audit(fixtures.raw(spark, sf_dir, entity), SOURCE_FILES[entity], LANDED_AT)

    run.__name__ = f"bronze_{entity}"
    return run


# --- Silver -----------------------------------------------------------------
def _silver(entity: str) -> Query:
    def run(spark, sf_dir):
        return _Tables(spark, sf_dir).judged_silver(entity).drop("_ingested_at")

    run.__name__ = f"silver_{entity}"
    return run


def _validate(entity: str) -> Query:
    def run(spark, sf_dir):
        t = _Tables(spark, sf_dir)
        return quality.evaluate(t.raw(entity), t.rules(entity))

    run.__name__ = f"validate_{entity}"
    return run


for _entity in ENTITIES:
    for _make in (_bronze, _silver, _validate):
        query(_make(_entity))


@query
def validate_fallback(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    parts = []
    for entity in ENTITIES:
        rules = quality.fallback_suite(entity, student_id=fixtures.STUDENT_ID)
        parts.append(quality.evaluate(t.raw(entity), rules).select(F.lit(entity).alias("entity"), "*"))
    return _union(parts)


@query
def suite_results(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    parts = []
    for entity in ENTITIES:
        fallback = quality.fallback_suite(entity, student_id=fixtures.STUDENT_ID)
        both = quality.summarise_both(t.raw(entity), t.rules(entity), fallback)
        failed = F.array_join("failed_expectations", ",").alias("failed_expectations")
        counts = ["success", "evaluated_expectations", "unsuccessful_expectations"]
        parts.append(both.select(F.lit(entity).alias("entity"), "engine", *counts, failed))
    return _union(parts)


@query
def silver_batch_metrics(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    parts = []
    for entity in ENTITIES:
        raw = t.raw(entity)
        verdict = quality.summarise(quality.evaluate(raw, t.rules(entity)))
        clean = SILVER[entity](raw).agg(F.count(F.lit(1)).alias("n")).scalar()
        parts.append(
            verdict.select(
                F.lit(entity).alias("entity"),
                F.col("checked_rows").alias("records_raw"),
                clean.alias("records_silver"),
                (F.col("checked_rows") - clean).alias("deduplicated"),
                "success",
                F.array_join("failed_expectations", ",").alias("failed_expectations"),
            )
        )
    return _union(parts)


@query
def rejected_batches(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    parts = []
    for entity in ENTITIES:
        raw = t.raw(entity)
        rejected = raw.where(~quality.passed(raw, t.rules(entity)))
        parts.append(rejected.agg(F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("rejected_rows")))
    return _union(parts)


@query
def ge_passed_rollup(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    parts = [t.judged_silver(e).select("_source", "_ge_passed") for e in ENTITIES]
    return _union([reports.audit_rollup(p) for p in parts])


# --- the stored path: files, Bronze, Silver, Gold, views -----------------------
def _stored(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The whole tables written out as source files, under a pipeline of their own."""
    root = new_folder(spark)
    for entity in ENTITIES:
        raw, path = fixtures.raw(spark, sf_dir, entity), f"{root}/in/{SOURCE_FILES[entity]}"
        if path.endswith(".json"):
            raw.write.json(path)
        else:
            blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            raw.write.options(header=True, **blanks).csv(path)
    patterns = {"student_id": fixtures.STUDENT_ID}
    return Pipeline(spark, f"{root}/in", f"{root}/lake", patterns=patterns, json_lines=True)


def _landed(entity: str) -> Query:
    def run(spark, sf_dir):
        pipeline = _stored(spark, sf_dir)
        pipeline.ingest(entity, RUN_DATE, LANDED_AT)
        return pipeline.lake.read_batch("bronze", entity, RUN_DATE)

    run.__name__ = f"landed_{entity}"
    return run


for _entity in ENTITIES:
    query(_landed(_entity))


@query
def rejected_rows(spark, sf_dir):
    """Every row of the batches that failed validation, from the folder they are kept in."""
    pipeline = _stored(spark, sf_dir)
    shown = {
        "students": ("student_id", "enrollment_status"),
        "attendance": ("attendance_id", "status"),
        "assessments": ("assessment_id", "subject"),
    }
    parts = []
    for entity, (record, detail) in shown.items():
        pipeline.ingest(entity, RUN_DATE)
        if not pipeline.transform(entity, RUN_DATE)["validation"]["success"]:
            rows = pipeline.lake.read_batch("rejected", entity, RUN_DATE)
            parts.append(
                rows.select(
                    F.lit(entity).alias("entity"), F.col(record).alias("record_id"), "student_id", F.col(detail).alias("detail")
                )
            )
    return _union(parts)


def _loaded(spark: SparkSession, sf_dir: str, entities: Sequence[str] = ENTITIES) -> Pipeline:
    """Gold tables of ``entities``; facts need the students too."""
    pipeline = _stored(spark, sf_dir)
    for entity in entities:
        pipeline.ingest(entity, RUN_DATE)
        pipeline.transform(entity, RUN_DATE)
    loads = {
        "students": pipeline.load_dim_students,
        "attendance": pipeline.load_fact_attendance,
        "assessments": pipeline.load_fact_assessments,
    }
    for entity in entities:
        loads[entity](RUN_DATE)
    return pipeline


@query
def stored_fact_attendance(spark, sf_dir):
    return _loaded(spark, sf_dir, ("students", "attendance")).lake.read_table(FACT_ATTENDANCE.table).drop("_ingested_at")


@query
def stored_fact_assessments(spark, sf_dir):
    return _loaded(spark, sf_dir, ("students", "assessments")).lake.read_table(FACT_ASSESSMENTS.table).drop("_ingested_at")


@query
def stored_mart(spark, sf_dir):
    """The mart as a whole run leaves it, asked by its SQL name."""
    pipeline = _loaded(spark, sf_dir)
    pipeline.compute_mart(LANDED_AT)
    pipeline.lake.register_views(RUN_DATE)
    return spark.sql("SELECT * FROM mart_class_daily_performance")


@query
def typed_sources(spark, sf_dir):
    """Ranges of numbers that a typed read of the files finds."""
    folder = _stored(spark, sf_dir).source_dir
    frames = {
        "students": (read_csv_typed(spark, f"{folder}/students.csv"), "grade_level"),
        "assessments": (read_json_typed(spark, f"{folder}/assessments.json", json_lines=True), "assessment_id"),
    }
    parts = []
    for name, (df, column) in frames.items():
        bounds = [f(F.col(column).cast("string")).alias(n) for n, f in (("least", F.min), ("most", F.max))]
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count(column).alias("filled"), *bounds))
    return _union(parts)


@query
def typed_schemas(spark, sf_dir):
    """The kinds of types that typed reads of the files infer, and their NULL cells."""
    folder = _stored(spark, sf_dir).source_dir
    numbers = {c: F.col(c).cast("double") for c in ("score", "max_score")}
    fixtures.raw(spark, sf_dir, "assessments").withColumns(numbers).write.json(f"{folder}/numbers.json")
    frames = {
        "students": read_csv_typed(spark, f"{folder}/students.csv"),
        "attendance": read_csv_typed(spark, f"{folder}/attendance.csv"),
        "assessments": read_json_typed(spark, f"{folder}/numbers.json", json_lines=True),
    }
    return _union([profiling.inferred_schema(df, name) for name, df in frames.items()])


@query
def gold_load_order(spark, sf_dir):
    """How the loaded tables lie on storage: rows out of order inside files, and files that overlap."""
    lake = _loaded(spark, sf_dir).lake
    tables = (DIM_STUDENTS, FACT_ATTENDANCE, FACT_ASSESSMENTS)
    return _union([profiling.load_order(lake.read_table(c.table), c.table, c.sort) for c in tables])


def _two_loads(spark: SparkSession, sf_dir: str, first: Contract, attendance_only: bool) -> Lake:
    """A lake whose mart was loaded under ``first``, then merged with the mart from one day on."""
    t = _Tables(spark, sf_dir)
    lake = Lake(spark, f"{new_folder(spark)}/lake")
    assessments = t.assessments.where(F.lit(False)) if attendance_only else t.assessments
    old = mart.class_daily_performance(t.dim, t.attendance, assessments, computed_at=LANDED_AT)
    lake.upsert_table(old.select(*first.columns), first)
    new = mart.class_daily_performance(t.dim, t.attendance, t.assessments, computed_at=LANDED_AT)
    lake.upsert_table(new.where(F.col("date") >= F.lit(DAY).cast("date")), MART)
    return lake


@query
def stored_mart_upsert(spark, sf_dir):
    """``mart_upsert`` over stored tables, with the load whose files hold each row."""
    lake = _two_loads(spark, sf_dir, MART, attendance_only=True)
    description = lake.describe(MART.table)
    folders = spark.createDataFrame(
        [(f.split("=")[-1], int(f.split("/")[0][2:])) for f in description.folders], "day string, loaded_by int"
    )
    rows = lake.read_table(MART.table).drop("_computed_at")
    return rows.join(folders, F.col("date").cast("string") == F.col("day")).drop("day")


@query
def stored_mart_defaults(spark, sf_dir):
    """Days loaded before the mart had its three assessment columns, beside days loaded since."""
    added = ("students_with_assessment", "assessment_count", "avg_score")
    before = replace(MART, fields=tuple(f for f in MART.fields if f.name not in added))
    return _two_loads(spark, sf_dir, before, attendance_only=False).read_table(MART.table).drop("_computed_at")


@query
def stored_mart_head(spark, sf_dir):
    """The mart's first rows by day, from the first days' folders alone."""
    t = _Tables(spark, sf_dir)
    lake = Lake(spark, f"{new_folder(spark)}/lake")
    lake.replace_table(t.mart, MART)
    return lake.table_head(MART.table, 20, ["date", "class_id"]).drop("_computed_at")


@query
def profile_previews(spark, sf_dir):
    """The first rows of each source by its id, and the least three stamps."""
    t = _Tables(spark, sf_dir)
    shown = {"students": ("student_id", "class_id"), "attendance": ("attendance_id", "status"), "assessments": ("assessment_id", "subject")}
    parts = [
        profiling.preview(t.raw(e), order_by=[record]).select(F.lit(e).alias("table_name"), F.col(record).alias("record_id"), F.col(detail).alias("detail"))
        for e, (record, detail) in shown.items()
    ]
    for e, column in (("students", "updated_at"), ("attendance", "created_at")):
        values = profiling.distinct_preview(t.raw(e), column)
        parts.append(values.select(F.lit(e).alias("table_name"), F.lit(column).alias("record_id"), F.col(column).alias("detail")))
    return _union(parts)


@query
def validate_isolated(spark, sf_dir):
    """Rules of which one can't run: it counts as passed, the others are judged."""
    t = _Tables(spark, sf_dir)
    rules = t.rules("students")
    rules[5] = quality.matches("class_id", "CLASS-[")
    return quality.evaluate_isolated(t.raw("students"), rules)


# --- Gold -------------------------------------------------------------------
@query
def gold_dim_students(spark, sf_dir):
    return _Tables(spark, sf_dir).dim.drop("_ingested_at")


@query
def gold_fact_attendance(spark, sf_dir):
    return _Tables(spark, sf_dir).attendance.drop("_ingested_at")


@query
def gold_fact_assessments(spark, sf_dir):
    return _Tables(spark, sf_dir).assessments.drop("_ingested_at")


@query
def contract_violations(spark, sf_dir):
    """Broken serving rules when dropped students are missing from the dimension."""
    t = _Tables(spark, sf_dir)
    students = SILVER["students"](fixtures.enrolled_students(t.raw("students")))
    tables = {
        "dim_students": gold.dim_students(students),
        "fact_attendance": gold.fact_attendance(t.silver("attendance"), students),
        "fact_assessments": gold.fact_assessments(t.silver("assessments"), students),
    }
    parts = []
    for name, df in tables.items():
        results = quality.evaluate(df, quality.contract_rules(CONTRACTS[name]))
        parts.append(
            results.select(F.lit(name).alias("table_name"), "rule", "column_name", "checked_rows", "failed_rows", "success")
        )
    return _union(parts)


@query
def gold_reload_or_keep(spark, sf_dir):
    """A full load replaces the dimension; an empty one leaves it as it was."""
    t = _Tables(spark, sf_dir)
    existing = gold.dim_students(SILVER["students"](fixtures.enrolled_students(t.raw("students"))))
    full = gold.dim_students(t.silver("students"))
    loads = {"full": full, "empty": full.where(F.lit(False))}
    kept = ["student_id", "student_name", "class_id", "grade_level", "enrollment_status"]
    return _union(
        [
            reload_or_keep(existing.select(*kept), incoming.select(*kept)).select(F.lit(name).alias("load"), "*")
            for name, incoming in loads.items()
        ]
    )


@query
def gold_row_counts(spark, sf_dir):
    """Rows per serving table."""
    t = _Tables(spark, sf_dir)
    tables = {
        "dim_students": t.dim,
        "fact_attendance": t.attendance,
        "fact_assessments": t.assessments,
        "mart_class_daily_performance": t.mart,
    }
    return _union(
        [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    )


# --- mart -------------------------------------------------------------------
@query
def mart_class_students(spark, sf_dir):
    return mart.class_sizes(_Tables(spark, sf_dir).dim)


@query
def mart_attendance_agg(spark, sf_dir):
    return mart.attendance_by_class_day(_Tables(spark, sf_dir).attendance)


@query
def mart_assessment_agg(spark, sf_dir):
    return mart.assessments_by_class_day(_Tables(spark, sf_dir).assessments)


@query
def mart_activity_keys(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return mart.activity_keys(
        t.attendance.select("class_id", F.col("attendance_date").alias("date")),
        t.assessments.select("class_id", F.col("assessment_date").alias("date")),
    )


@query
def mart_class_daily_performance(spark, sf_dir):
    return _Tables(spark, sf_dir).mart.drop("_computed_at")


@query
def mart_upsert(spark, sf_dir):
    """An attendance-only mart, then the full mart from one day on."""
    t = _Tables(spark, sf_dir)
    no_assessments = t.assessments.where(F.lit(False))
    first = mart.class_daily_performance(t.dim, t.attendance, no_assessments).drop("_computed_at")
    rerun = t.mart.drop("_computed_at").where(F.col("date") >= F.lit(DAY).cast("date"))
    return upsert(first, rerun, ["class_id", "date"])


# --- reports ----------------------------------------------------------------
def _on_mart(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark, sf_dir):
        return build(_Tables(spark, sf_dir).mart)

    run.__name__ = name
    query(run)


_on_mart("mart_full", lambda m: reports.full_mart(m.drop("_computed_at")))
_on_mart("mart_ordered_head", lambda m: reports.mart_head(m.drop("_computed_at")))
_on_mart("class_avg_attendance", reports.class_averages)
_on_mart("lowest_attendance_on_date", lambda m: reports.lowest_attendance(m, DAY))
_on_mart("class_daily_trend", lambda m: reports.class_trend(m, CLASS))
_on_mart("report_rate_trend", reports.attendance_rate_trend)
_on_mart("report_score_by_class", reports.score_by_class)
_on_mart("report_present_absent", reports.present_absent_by_class)
_on_mart("report_mart_table", reports.mart_table)


@query
def report_request_limits(spark, sf_dir):
    """One request without a limit, under a server's default and without any, and one that names its own."""
    t = _Tables(spark, sf_dir)
    table = reports.Request(columns=["class_id", "date", "present_count"], order_by=["class_id", "date"])
    server = reports.RequestSettings(default_limit=25)
    asked = {
        "default": (table, server),
        "named": (replace(table, row_limit=40), server),
        "all": (table, reports.RequestSettings()),
    }
    return _union([reports.answer(t.mart, *a).select(F.lit(name).alias("request"), "*") for name, a in asked.items()])


@query
def students_per_class_grade(spark, sf_dir):
    return reports.students_per_class_and_grade(_Tables(spark, sf_dir).dim)


@query
def avg_score_by_subject(spark, sf_dir):
    return reports.subject_averages(_Tables(spark, sf_dir).assessments)


@query
def top5_students(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return reports.top_students(t.assessments, t.dim)


@query
def attendance_on_date_detail(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return reports.attendance_detail(t.attendance, t.dim, DAY)


@query
def report_score_by_subject(spark, sf_dir):
    return reports.score_by_subject(_Tables(spark, sf_dir).assessments)


# --- profiles ---------------------------------------------------------------
@query
def profile_shape_nulls(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return _union([profiling.shape_and_nulls(t.raw(e), e) for e in ENTITIES])


@query
def profile_value_counts(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return _union(
        [
            profiling.value_counts(t.raw("students"), "students", ["enrollment_status", "class_id", "grade_level"]),
            profiling.value_counts(t.raw("attendance"), "attendance", ["status"]),
            profiling.value_counts(t.raw("assessments"), "assessments", ["subject"]),
        ]
    )


@query
def profile_distinct_values(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return _union(
        [
            profiling.distinct_values(t.raw("students"), "students", ["grade_level", "class_id", "updated_at"]),
            profiling.distinct_values(t.raw("assessments"), "assessments", ["max_score"]),
        ]
    )


@query
def profile_distincts(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return _union(
        [
            profiling.distinct_counts(t.raw("students"), "students", ["grade_level", "class_id", "updated_at"]),
            profiling.distinct_counts(t.raw("assessments"), "assessments", ["max_score"]),
        ]
    )


@query
def profile_date_ranges(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return _union(
        [
            profiling.date_range(t.raw("attendance"), "attendance", "attendance_date"),
            profiling.date_range(t.raw("assessments"), "assessments", "assessment_date"),
        ]
    )


@query
def profile_duplicates(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    students, attendance, assessments = (t.raw(e) for e in ENTITIES)
    return _union(
        [
            profiling.duplicates(students, "students", ["student_id"]),
            profiling.duplicates(attendance, "attendance", ["attendance_id"]),
            profiling.duplicates(attendance, "attendance", profiling.ATTENDANCE_KEY),
            profiling.duplicates(assessments, "assessments", ["assessment_id"]),
            profiling.duplicates(assessments, "assessments", profiling.ASSESSMENT_KEY),
        ]
    )


@query
def repeated_attendance_rows(spark, sf_dir):
    return profiling.repeated_attendance(_Tables(spark, sf_dir).raw("attendance"))


@query
def duplicate_status_signature(spark, sf_dir):
    return profiling.status_signatures(_Tables(spark, sf_dir).raw("attendance"))


@query
def profile_dedup_effect(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return profiling.dedup_effect(t.raw("attendance"), t.raw("assessments"))


@query
def profile_latest_assessments(spark, sf_dir):
    return profiling.latest_assessments(_Tables(spark, sf_dir).raw("assessments"))


@query
def profile_first_by_status(spark, sf_dir):
    return profiling.first_by_status(_Tables(spark, sf_dir).raw("attendance"))


@query
def records_per_day(spark, sf_dir):
    return profiling.rows_per_day(_Tables(spark, sf_dir).raw("attendance"))


@query
def score_describe(spark, sf_dir):
    return profiling.score_description(_Tables(spark, sf_dir).raw("assessments"))


@query
def score_histogram(spark, sf_dir):
    return profiling.score_histogram(_Tables(spark, sf_dir).raw("assessments"))


@query
def subject_mean_desc(spark, sf_dir):
    return profiling.subject_means(_Tables(spark, sf_dir).raw("assessments"))


@query
def class_attendance_rate(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return profiling.class_attendance(t.raw("attendance"), t.raw("students"))


@query
def class_subject_pivot(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return profiling.subject_pivot(t.raw("assessments"), t.raw("students"))


@query
def daily_score_trend(spark, sf_dir):
    return profiling.daily_means(_Tables(spark, sf_dir).raw("assessments"))


def _orphans(spark, sf_dir, entity: str) -> DataFrame:
    t = _Tables(spark, sf_dir)
    return orphan_rows(t.raw(entity), fixtures.enrolled_students(t.raw("students")), "student_id")


@query
def orphan_attendance_rows(spark, sf_dir):
    return _orphans(spark, sf_dir, "attendance")


@query
def orphan_assessment_rows(spark, sf_dir):
    return _orphans(spark, sf_dir, "assessments")


@query
def orphan_student_ids(spark, sf_dir):
    """The distinct orphan ids with their row counts."""
    t = _Tables(spark, sf_dir)
    students = fixtures.enrolled_students(t.raw("students"))
    return _union(
        [
            orphan_keys(t.raw(e), students, "student_id").select(F.lit(e).alias("table_name"), "student_id", "row_count")
            for e in ("attendance", "assessments")
        ]
    )


@query
def readiness_checklist(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    return profiling.readiness({e: t.raw(e) for e in ENTITIES})

"""The whole batch: files to Bronze, Silver, Gold and the mart, under one run date."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from datetime import datetime
from functools import partial, partialmethod

from pyspark.sql import DataFrame, SparkSession

from tallyroll.plans import gold, mart, quality
from tallyroll.plans.silver import SILVER
from tallyroll.schemas import (
    DIM_STUDENTS,
    ENTITIES,
    FACT_ASSESSMENTS,
    FACT_ATTENDANCE,
    MART,
    SOURCE_COLUMNS,
    SOURCE_FILES,
)
from tallyroll.session import check_settings
from tallyroll.sources.files import MissingColumn, read_csv_text, read_json_text, with_audit
from tallyroll.sources.lake import Lake

logger = logging.getLogger(__name__)


class Pipeline:
    """The stages over one source folder and one lake folder.

    ``patterns`` are the id patterns of the quality rules; ``engine`` picks the
    rule set; ``isolate_rules`` judges a suite without the rules that raise. Gold tables keep ``keep_versions`` versions, so a reader of the one
    before last is safe. Each stage reads what the one before wrote, so nothing upstream is
    computed twice.
    """

    def __init__(
        self,
        spark: SparkSession,
        source_dir: str,
        lake_root: str,
        *,
        engine: str = "primary",
        patterns: Mapping[str, str] | None = None,
        json_lines: bool = False,
        multiline_csv: bool = False,
        keep_versions: int = 2,
        isolate_rules: bool = False,
    ):
        check_settings(spark)
        self.spark = spark
        self.source_dir = source_dir
        self.lake = Lake(spark, lake_root)
        self.engine = engine
        self.patterns = dict(patterns or {})
        self.json_lines = json_lines
        self.multiline_csv = multiline_csv
        self.keep_versions = keep_versions
        self.isolate_rules = isolate_rules

    # --- files to Bronze ----------------------------------------------------
    def read_source(self, entity: str) -> DataFrame:
        path = f"{self.source_dir}/{SOURCE_FILES[entity]}"
        columns = SOURCE_COLUMNS[entity]
        if path.endswith(".json"):
            return read_json_text(self.spark, path, columns, json_lines=self.json_lines)
        return read_csv_text(self.spark, path, columns, multiline=self.multiline_csv)

    def ingest(self, entity: str, run_date: str, ingested_at: datetime | None = None) -> str:
        """Land one source; duplicates stay. Returns the batch folder."""
        landed = with_audit(self.read_source(entity), SOURCE_FILES[entity], ingested_at)
        accept = partial(self._refuse_absent_keys, entity) if SOURCE_FILES[entity].endswith(".json") else None
        self.lake.write_batch(landed, "bronze", entity, run_date, accept)
        return self.lake.batch_path("bronze", entity, run_date)

    ingest_students = partialmethod(ingest, "students")
    ingest_attendance = partialmethod(ingest, "attendance")
    ingest_assessments = partialmethod(ingest, "assessments")

    def _refuse_absent_keys(self, entity: str, counts: Mapping[str, int]) -> None:
        """A JSON key that no record has reads as NULL everywhere, as does one that is always null.

        Only if a column has no value at all are the keys of the file looked up,
        to tell the two apart: the first is refused, the second accepted.
        """
        blank = [c for c in SOURCE_COLUMNS[entity] if counts["rows"] and not counts[c]]
        if blank:
            path = f"{self.source_dir}/{SOURCE_FILES[entity]}"
            keys = read_json_text(self.spark, path, json_lines=self.json_lines).columns
            absent = [c for c in blank if c not in keys]
            if absent:
                raise MissingColumn(f"{path} has no key {', '.join(absent)}")

    # --- Bronze to Silver ---------------------------------------------------
    def transform(self, entity: str, run_date: str) -> dict:
        """Validate, quarantine a failed batch as it is, and write Silver either way."""
        raw = self.lake.read_batch("bronze", entity, run_date)
        validation = quality.run_suite(raw, entity, self.engine, self.isolate_rules, **self._patterns_for(entity))
        if not validation["success"]:
            logger.warning("%s failed validation: %s", entity, validation["failed_expectations"])
            self.lake.write_batch(raw, "rejected", entity, run_date)
        records_raw = validation.pop("checked_rows")
        if records_raw is None:
            records_raw = raw.count()
        records_silver = self.lake.write_batch(
            SILVER[entity](raw, validation["success"]), "silver", entity, run_date
        )
        return {
            "records_raw": records_raw,
            "records_silver": records_silver,
            "deduplicated": records_raw - records_silver,
            "key": self.lake.batch_path("silver", entity, run_date),
            "validation": validation,
        }

    transform_students = partialmethod(transform, "students")
    transform_attendance = partialmethod(transform, "attendance")
    transform_assessments = partialmethod(transform, "assessments")

    def _patterns_for(self, entity: str) -> dict[str, str]:
        known = {"student_id", "class_id"} if self.engine == "primary" else {"student_id"}
        return {k: v for k, v in self.patterns.items() if k in known}

    def silver_summary(self, results: Mapping[str, dict]) -> DataFrame:
        """One row per entity: raw, clean and removed rows, the verdict and the failed rules."""
        rows = [
            (
                entity,
                r["records_raw"],
                r["records_silver"],
                r["deduplicated"],
                r["validation"]["success"],
                r["validation"]["engine"],
                ",".join(r["validation"]["failed_expectations"]),
            )
            for entity, r in results.items()
        ]
        schema = (
            "entity string, records_raw long, records_silver long, deduplicated long, "
            "success boolean, engine string, failed_expectations string"
        )
        return self.spark.createDataFrame(rows, schema)

    # --- Silver to Gold -----------------------------------------------------
    def _silver(self, entity: str, run_date: str) -> DataFrame:
        return self.lake.read_batch("silver", entity, run_date)

    def load_dim_students(self, run_date: str) -> int:
        return self.lake.replace_table(gold.dim_students(self._silver("students", run_date)), DIM_STUDENTS)

    def load_fact_attendance(self, run_date: str) -> int:
        fact = gold.fact_attendance(self._silver("attendance", run_date), self._silver("students", run_date))
        return self.lake.replace_table(fact, FACT_ATTENDANCE)

    def load_fact_assessments(self, run_date: str) -> int:
        fact = gold.fact_assessments(self._silver("assessments", run_date), self._silver("students", run_date))
        return self.lake.replace_table(fact, FACT_ASSESSMENTS)

    def compute_mart(self, computed_at: datetime | None = None) -> int:
        """Compute the mart from the written Gold tables and merge it by (class, day)."""
        tables = [self.lake.read_table(c.table) for c in (DIM_STUDENTS, FACT_ATTENDANCE, FACT_ASSESSMENTS)]
        return self.lake.upsert_table(mart.class_daily_performance(*tables, computed_at=computed_at), MART)

    def gold_summary(self, rows: Mapping[str, int]) -> DataFrame:
        return self.spark.createDataFrame(list(rows.items()), "table_name string, row_count long")

    # --- all of it ----------------------------------------------------------
    def run(self, run_date: str) -> dict:
        """Every stage in order, all with the same run date."""
        bronze = {e: self.ingest(e, run_date) for e in ENTITIES}
        silver = {e: self.transform(e, run_date) for e in ENTITIES}
        loaded = {
            "dim_students": self.load_dim_students(run_date),
            "fact_attendance": self.load_fact_attendance(run_date),
            "fact_assessments": self.load_fact_assessments(run_date),
        }
        loaded["mart_class_daily_performance"] = self.compute_mart()
        for table in loaded:
            self.lake.drop_old_versions(table, self.keep_versions)
        return {"bronze": bronze, "silver": silver, "gold": loaded}

"""Named data-quality rules, evaluated without blocking the run.

A rule is a SQL predicate that is true for a row that breaks it, so an empty
batch passes. All row rules of a suite are counted in one aggregate over one
scan; a uniqueness rule adds one scan of its own column.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyroll.functions.numbers import number_or_null
from tallyroll.schemas import (
    CLASS_ID_PATTERN,
    ENROLLMENT_STATUSES,
    GRADE_LEVELS,
    STATUSES,
    STUDENT_ID_PATTERN,
    SUBJECTS,
    Contract,
)

logger = logging.getLogger(__name__)

# --- fixed values: names reported for failed rules ---------------------------
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    column: str
    # SQL predicate of a broken row; a uniqueness rule has none.
    broken: str | None = None
    # Whether two NULLs break uniqueness.
    nulls_repeat: bool = False


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", NOT_NULL, column, f"{column} is null")


def unique(column: str, nulls_repeat: bool = False) -> Rule:
    return Rule(f"{column}_unique", UNIQUE, column, nulls_repeat=nulls_repeat)


def matches(column: str, pattern: str) -> Rule:
    """NULL cells are not judged."""
    return Rule(f"{column}_format", REGEX, column, f"not ({column} rlike {_quoted(pattern)})")


def in_set(column: str, allowed: Sequence[str], null_breaks: bool = False) -> Rule:
    """Judged on the raw value, before any trimming."""
    listed = ", ".join(_quoted(v) for v in allowed)
    return Rule(f"{column}_valid", IN_SET, column, f"coalesce({column} not in ({listed}), {str(null_breaks).lower()})")


def score_non_negative() -> Rule:
    """A score that is no number breaks the rule."""
    return Rule("score_non_negative", "score_non_negative", "score", f"not coalesce({number_or_null('score')} >= 0, false)")


def score_within_max() -> Rule:
    ok = f"{number_or_null('score')} <= {number_or_null('max_score')}"
    return Rule("score_lte_max", "score_lte_max", "score", f"not coalesce({ok}, false)")


def primary_suite(entity: str, student_id: str = STUDENT_ID_PATTERN, class_id: str = CLASS_ID_PATTERN) -> list[Rule]:
    """The full rule set; NULL cells are only judged by the not-null rules."""
    suites = {
        "students": [
            not_null("student_id"),
            unique("student_id"),
            matches("student_id", student_id),
            not_null("student_name"),
            not_null("class_id"),
            matches("class_id", class_id),
            in_set("enrollment_status", ENROLLMENT_STATUSES),
        ],
        "attendance": [
            not_null("attendance_id"),
            unique("attendance_id"),
            not_null("student_id"),
            matches("student_id", student_id),
            not_null("attendance_date"),
            not_null("status"),
            in_set("status", STATUSES),
        ],
        "assessments": [
            not_null("assessment_id"),
            unique("assessment_id"),
            not_null("student_id"),
            matches("student_id", student_id),
            not_null("subject"),
            in_set("subject", SUBJECTS),
            not_null("score"),
            not_null("max_score"),
            not_null("assessment_date"),
        ],
    }
    return suites[entity]


def fallback_suite(entity: str, student_id: str = STUDENT_ID_PATTERN) -> list[Rule]:
    """The second rule set: fewer rules, the score bounds, and NULL outside every value set."""
    suites = {
        "students": [
            not_null("student_id"),
            unique("student_id", nulls_repeat=True),
            matches("student_id", student_id),
            not_null("class_id"),
            in_set("grade_level", GRADE_LEVELS, null_breaks=True),
            in_set("enrollment_status", ENROLLMENT_STATUSES, null_breaks=True),
        ],
        "attendance": [
            not_null("attendance_id"),
            unique("attendance_id", nulls_repeat=True),
            not_null("student_id"),
            not_null("attendance_date"),
            in_set("status", STATUSES, null_breaks=True),
        ],
        "assessments": [
            not_null("assessment_id"),
            unique("assessment_id", nulls_repeat=True),
            not_null("student_id"),
            in_set("subject", SUBJECTS, null_breaks=True),
            score_non_negative(),
            score_within_max(),
        ],
    }
    return suites[entity]


def contract_rules(contract: Contract) -> list[Rule]:
    """What the serving table enforces: key, NOT NULL, value sets, lengths and number ranges."""
    rules = [Rule(f"{contract.table}_key_unique", "primary_key", ",".join(contract.key), nulls_repeat=True)]
    for f in contract.fields:
        if not f.nullable:
            rules.append(Rule(f"{f.name}_not_null", "not_null", f.name, f"{f.name} is null"))
        if f.allowed:
            listed = ", ".join(_quoted(v) for v in f.allowed)
            rules.append(Rule(f"{f.name}_check", "check", f.name, f"{f.name} not in ({listed})"))
        if f.max_length:
            rules.append(Rule(f"{f.name}_length", "length", f.name, f"length({f.name}) > {f.max_length}"))
        if f.type.startswith("decimal") or f.type == "int":
            lost = f"{f.name} is not null and try_cast({f.name} as {f.type}) is null"
            rules.append(Rule(f"{f.name}_range", "range", f.name, lost))
    return rules


def broken_row_counts(rules: Sequence[Rule]) -> list:
    """One count per row rule, fit for ``agg`` and for ``observe``."""
    return [F.expr(f"count_if({r.broken}) as broken_{i}") for i, r in enumerate(rules) if r.broken is not None]


def _labels(rule: Rule, seq: int) -> str:
    return f"{seq}, {_quoted(rule.name)}, {_quoted(rule.kind)}, {_quoted(rule.column)}"


def _uniqueness(df: DataFrame, column: str, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """All uniqueness rules of one key, from one count per key."""
    columns = column.split(",")
    filled = " and ".join(f"{c} is not null" for c in columns)
    failed = [
        F.expr(f"coalesce(sum(n) filter (where n > 1{'' if r.nulls_repeat else f' and {filled}'}), 0L) as failed_{i}")
        for i, r in rules
    ]
    counted = df.groupBy(*columns).agg(F.expr("count(1) as n"))
    totals = counted.agg(F.expr("coalesce(sum(n), 0L) as checked_rows"), *failed)
    stacked = ", ".join(f"{_labels(r, i)}, failed_{i}" for i, r in rules)
    return totals.selectExpr("checked_rows", f"stack({len(rules)}, {stacked}) as {_RESULT}")


_RESULT = "(seq, rule, expectation, column_name, failed_rows)"


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``seq, rule, expectation, column_name, checked_rows, failed_rows, success``."""
    row_rules = [(i, r) for i, r in enumerate(rules) if r.broken is not None]
    pieces = []
    if row_rules:
        counts = df.agg(F.expr("count(1) as checked_rows"), *broken_row_counts(rules))
        stacked = ", ".join(f"{_labels(r, i)}, broken_{i}" for i, r in row_rules)
        pieces.append(counts.selectExpr("checked_rows", f"stack({len(row_rules)}, {stacked}) as {_RESULT}"))
    keys: dict[str, list[tuple[int, Rule]]] = {}
    for i, r in enumerate(rules):
        if r.broken is None:
            keys.setdefault(r.column, []).append((i, r))
    pieces += [_uniqueness(df, column, own) for column, own in keys.items()]
    return reduce(DataFrame.unionByName, pieces).selectExpr(
        "seq", "rule", "expectation", "column_name", "checked_rows", "failed_rows", "failed_rows = 0 as success"
    )


def evaluate_isolated(df: DataFrame, rules: Sequence[Rule], engine: str = "primary") -> DataFrame:
    """``evaluate`` now, with the ``engine`` of every rule: ``error`` where the rule itself fails to run.

    All rules are counted in one pass. If that raises, halves of them are tried until the rules
    that raise are alone: they count as passed, with no counts, and the others are judged as ever. With
    k failing rules of n that takes about k * log(n) passes more.
    """
    schema = evaluate(df, [not_null(df.columns[0])]).withColumn("engine", F.lit("")).schema

    def attempt(part: Sequence[tuple[int, Rule]]) -> list[tuple]:
        try:
            found = evaluate(df, [rule for _, rule in part]).collect()  # one row per rule
        except Exception as error:  # a failing check must never stop the batch
            if len(part) > 1:
                half = len(part) // 2
                return attempt(part[:half]) + attempt(part[half:])
            seq, rule = part[0]
            logger.error("rule %s failed to run: %s; treated as passed", rule.name, error)
            return [(seq, rule.name, rule.kind, rule.column, None, None, True, "error")]
        return [(part[r["seq"]][0], *tuple(r)[1:], engine) for r in found]

    rows = sorted(attempt(list(enumerate(rules))), key=lambda r: r[0]) if rules else []
    return df.sparkSession.createDataFrame(rows, StructType([StructField(f.name, f.dataType) for f in schema]))


def summarise(results: DataFrame, engine: str = "primary") -> DataFrame:
    """One row for a whole suite; the failed list keeps the order of the rules."""
    reported = "expectation" if engine == "primary" else "rule"
    failed = f"array_sort(collect_list(if(success, null, struct(seq, {reported} as name))))"
    return results.agg(
        F.expr("count_if(not success) = 0 as success"),
        F.expr("count(1) as evaluated_expectations"),
        F.expr("count_if(success) as successful_expectations"),
        F.expr("count_if(not success) as unsuccessful_expectations"),
        F.expr("max(checked_rows) as checked_rows"),
        F.expr(f"{failed}.name as failed_expectations"),
        F.expr(f"{_quoted(engine)} as engine"),
    )


def summarise_both(df: DataFrame, primary: Sequence[Rule], fallback: Sequence[Rule]) -> DataFrame:
    """One row per suite, from one pass over the rows and one per key for both together."""
    first = F.col("seq") < len(primary)
    named = F.when(F.col("success"), None).otherwise(F.struct("seq", F.when(first, F.col("expectation")).otherwise(F.col("rule")).alias("name")))
    results = evaluate(df, [*primary, *fallback]).withColumn("failed", named)
    return results.groupBy(F.when(first, "primary").otherwise("fallback").alias("engine")).agg(
        F.expr("count_if(not success) = 0 as success"),
        F.expr("count(1) as evaluated_expectations"),
        F.expr("count_if(not success) as unsuccessful_expectations"),
        F.expr("array_sort(collect_list(failed)).name as failed_expectations"),
    )


def passed(df: DataFrame, rules: Sequence[Rule]):
    """The batch verdict as a scalar subquery, for plans that must stay lazy."""
    return summarise(evaluate(df, rules)).select("success").scalar()


def run_suite(df: DataFrame, entity: str, engine: str = "primary", isolate: bool = False, **patterns) -> dict:
    """Evaluate a suite now. An error in the engine is logged and treated as passed.

    With ``isolate`` only the rules that raise are treated so, and the rest of the suite is judged.
    """
    try:
        rules = primary_suite(entity, **patterns) if engine == "primary" else fallback_suite(entity, **patterns)
        row = summarise((evaluate_isolated if isolate else evaluate)(df, rules), engine).first()
    except Exception as error:  # a failing check must never stop the batch
        logger.error("validation of %s failed to run: %s; treated as passed", entity, error)
        return {"success": True, "statistics": {}, "failed_expectations": [], "engine": "error", "checked_rows": None}

    evaluated, broken = row["evaluated_expectations"], row["unsuccessful_expectations"]
    if engine == "primary":
        statistics = {
            "evaluated_expectations": evaluated,
            "successful_expectations": evaluated - broken,
            "unsuccessful_expectations": broken,
            "success_percent": 100.0 * (evaluated - broken) / evaluated,
        }
    else:
        statistics = {"evaluated_expectations": evaluated, "failed_expectations": broken}
    return {
        "success": row["success"],
        "statistics": statistics,
        "failed_expectations": list(row["failed_expectations"]),
        "engine": engine,
        "checked_rows": row["checked_rows"],
    }

"""What the physical plans must and must not hold."""

import re

import pytest

from tallyroll import fixtures
from tallyroll.operators.dedup import duplicated_rows
from tallyroll.operators.lookup import orphan_keys, orphan_rows
from tallyroll.plans.silver import SILVER
from tallyroll.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_worker(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not [node for node in FORBIDDEN if node in plan]


@pytest.mark.parametrize("entity", ["attendance", "assessments"])
def test_dedup_limits_groups_before_its_only_shuffle(spark, sf_dir, entity):
    plan = plan_of(SILVER[entity](fixtures.raw(spark, sf_dir, entity)))
    assert plan.count("Exchange hashpartitioning") == 1
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["records_per_day"](spark, sf_dir))
    assert "Not(EqualTo(event_type,purchase))" in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", plan)


def test_mart_reads_each_fact_once(spark, sf_dir):
    plan = plan_of(QUERIES["mart_class_daily_performance"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet .*events\.parquet", plan)) == 2
    assert "FullOuter" not in plan


@pytest.mark.parametrize(("name", "literal"), [("lowest_attendance_on_date", "2024-01-10"), ("class_daily_trend", "CLASS-01")])
def test_filters_on_the_mart_reach_both_facts(spark, sf_dir, name, literal):
    """Below the dedup windows for the day; on the student side of both enrichment joins for the class."""
    lines = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    filters = [i for i, line in enumerate(lines) if "Filter" in line and literal in line]
    marker = "Window" if literal[0] == "2" else "Join"
    above = [i for i, line in enumerate(lines) if marker in line]
    assert len([i for i in filters if i > min(above)]) >= 2
    assert not [i for i in filters if i < min(above)]


def test_both_suites_in_one_pass(spark, sf_dir):
    plan = plan_of(QUERIES["suite_results"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet ", plan)) <= 6


@pytest.fixture
def small_broadcast_off(spark):
    keep = {}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        keep[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    yield
    for key, value in keep.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_key_joins_are_split(spark, small_broadcast_off, tmp_path):
    """A third of the rows on one key, no broadcast: the row side is split and the result is whole."""
    path = str(tmp_path / "rows")
    spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 20000)) as k", "sha2(cast(id as string), 256) as payload"
    ).repartition(8).write.parquet(path)
    rows = spark.read.parquet(path)
    rows.where("k <> 'hot' and payload < '8'").select("k").distinct().write.parquet(path + "_dim")
    dim = spark.read.parquet(path + "_dim")

    orphans = orphan_rows(rows, dim, "k")
    known = {r.k for r in dim.collect()}
    expected = [r.payload for r in rows.collect() if r.k not in known]
    assert sorted(r.payload for r in orphans.collect()) == sorted(expected)
    assert "skew=true" in plan_of(orphans)

    repeated = duplicated_rows(rows, ["k"])
    counts = rows.groupBy("k").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert len(repeated.collect()) == counts
    assert "skew=true" in plan_of(repeated)

    by_key = {r.k: r.row_count for r in orphan_keys(rows, dim, "k").collect()}
    assert by_key["hot"] == 20_000 and sum(by_key.values()) == len(expected)

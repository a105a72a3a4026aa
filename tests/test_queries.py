"""Every registered query against its SQL counterpart, and the shape of the plans."""

from __future__ import annotations

import pytest
from check_oracle import differences, oracle_connection
from conftest import SMALL, plan_of

import __spark_entry__ as entry

# The text operators, which may be missing, have tests of their own in tests/llm.
TEXT, TEXT_SQL = entry._text_queries()
QUERIES = {name: q for name, q in entry.queries().items() if name not in TEXT}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name not in TEXT_SQL}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    problem, rows = differences(QUERIES[name](spark, SMALL), ORACLE[name], con)
    assert problem is None
    assert rows > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 3406


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in ("silver", "dim", "fact", "kpi", "dq")])
def test_plans_stay_in_the_jvm_and_never_pair_up_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["kpi_maintenance_summary"](spark, SMALL))
    scan = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in scan
    counts = plan_of(QUERIES["dq_key_uniqueness"](spark, SMALL))
    nation = next(line for line in counts.splitlines() if "nation.parquet" in line)
    assert "n_name" in nation  # the name is required by the contract, so even a count reads it


STORING = {
    "silver_sensor_events", "layer_round_trip", "batch_pipeline", "stored_insert_if_absent", "stream_quality",
    "stream_report", "stream_progress", "stream_completeness", "newest_by_day", "stream_accounts", "refused_events", "staged_publication",
    "late_events", "late_keys",
    *(n for n in QUERIES if n.startswith(("incremental_", "colocated_"))),
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STORING])
def test_building_a_query_runs_no_job_and_changes_no_setting(spark, name):
    context, conf = spark.sparkContext, spark._jsparkSession.conf()
    group, settings = f"build-{name}", lambda: str(context._jvm.scala.jdk.javaapi.CollectionConverters.asJava(conf.getAll()))
    before = settings()
    context.setJobGroup(group, name)
    try:
        QUERIES[name](spark, SMALL).schema  # noqa: B018
        assert not list(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert settings() == before

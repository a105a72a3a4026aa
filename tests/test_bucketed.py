"""Bucketed layer tables: the plans have no shuffle by the key, the results are the same."""

from __future__ import annotations

import glob
import re

import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as entry
from millrace.operators.dedupe import dedupe
from millrace.operators.enrich import enrich
from millrace.operators.quality import key_uniqueness
from millrace.plans import marts
from millrace.sources.bucketed import read_bucketed, register, table_name, write_bucketed


@pytest.fixture
def unbroadcast(spark):
    """Tables as large as they are meant to be: too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))


@pytest.fixture
def machines_and_facts(spark, layout, unbroadcast):
    entry.colocated(spark, SMALL, layout, "machine_id", 4)
    frames = {t: read_bucketed(spark, layout, "gold", t) for t in ("dim_machines", *marts.FACT_KEYS)}
    return frames


def test_gold_joins_need_no_shuffle(machines_and_facts):
    machines = machines_and_facts["dim_machines"]
    for fact in marts.FACT_KEYS:
        joined = enrich(machines_and_facts[fact], machines, "machine_id", ["workshop_id"])
        assert "Join" in plan_of(joined) and shuffles(joined) == []
    facts = [machines_and_facts[t] for t in marts.FACT_KEYS]
    assert shuffles(marts.kpi_machine_performance(*facts, machines)) == []
    # Sums by other keys are shuffled once, after the join.
    daily = marts.kpi_daily_production(facts[0], marts.machine_reference(machines))
    assert len(shuffles(daily)) == 1 and "machine_id" not in shuffles(daily)[0]


def test_plain_tables_are_shuffled(spark, unbroadcast):
    assert shuffles(entry.queries()["kpi_machine_performance"](spark, SMALL))


def test_key_checks_and_dedup_need_no_shuffle(spark, layout):
    fact = entry.fact_production(spark, SMALL)
    write_bucketed(fact.unionAll(fact), layout, "gold", "fact_production", "production_id", 4)
    stored = read_bucketed(spark, layout, "gold", "fact_production")
    assert shuffles(key_uniqueness(stored, "fact_production", "production_id")) == []
    assert shuffles(dedupe(stored, "production_id")) == []
    n = fact.count()
    report = key_uniqueness(stored, "fact_production", "production_id").first()
    assert (report.rows, report.keys) == (2 * n, n) and dedupe(stored, "production_id").count() == n


def test_a_file_a_bucket_and_overwriting(spark, layout):
    df = spark.range(100).selectExpr("id", "id % 7 as k", "cast(null as string) as `odd name`")
    for rows in (df, df.where("id < 50")):
        write_bucketed(rows, layout, "gold", "t", "id", 4)
        assert len(glob.glob(f"{layout.root}/gold/t/*.parquet")) == 4
        assert read_bucketed(spark, layout, "gold", "t").count() == rows.count()
    write_bucketed(df.limit(0), layout, "gold", "t", "id", 4)
    assert read_bucketed(spark, layout, "gold", "t").count() == 0


def test_another_session_registers_the_table(spark, layout):
    write_bucketed(spark.range(100).selectExpr("id", "id % 7 as k"), layout, "gold", "t", "id", 4)
    spark.sql(f"DROP TABLE {table_name(layout, 'gold', 't')}")  # the files stay
    register(spark, layout, "gold", "t", "id", 4)
    stored = read_bucketed(spark, layout, "gold", "t")
    assert stored.count() == 100 and shuffles(stored.groupBy("id").count()) == []

"""The batch chain over stored layers, end to end."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import SMALL
from pyarrow.parquet import ParquetFile
from test_sources import FolderTarget

import __spark_entry__ as entry
import testbed
from millrace.operators.quality import QualityError
from millrace.plans import marts, pipeline
from millrace.plans.tables import OPERATIONAL_TABLES
from millrace.sources.layers import Layout, read_layer


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("lake")))
    target = FolderTarget(layout)
    result = pipeline.run_batch(spark, layout, testbed.GivenTables(SMALL), target, testbed.TIE_BREAKS)
    return layout, result


def test_run_id():
    at = datetime(2024, 5, 1, 2, 3, 4, tzinfo=timezone(timedelta(hours=2)))
    assert pipeline.run_id(at) == "20240501T000304Z"


def test_bronze_carries_its_origin(spark, lake):
    row = read_layer(spark, lake[0], "bronze", "alerts").first()
    assert (row._source_system, row._source_table) == ("testbed", "alerts")
    assert len(row._ingestion_id) == 16 and row._ingestion_timestamp is not None


@pytest.mark.parametrize("table", list(OPERATIONAL_TABLES))
def test_silver_accounts_for_every_bronze_row(spark, lake, table):
    layout, result = lake
    counts = result.silver[table]
    assert counts.bronze == result.bronze[table] == counts.silver + counts.duplicates + counts.invalid
    assert counts.rejected == counts.duplicates + counts.invalid
    stored = read_layer(spark, layout, "silver", table)
    key = OPERATIONAL_TABLES[table].key
    assert stored.count() == counts.silver == stored.select(key).distinct().count()
    assert {"_silver_processed_at", "_ingestion_id"} <= set(stored.columns)


def test_silver_counts_equal_the_reports(spark, lake):
    _, result = lake
    report = {r["table"]: r for r in entry.queries()["dq_row_counts"](spark, SMALL).collect()}
    for t, c in result.silver.items():
        assert (report[t].bronze, report[t].duplicates, report[t].invalid, report[t].silver) == (
            c.bronze, c.duplicates, c.invalid, c.silver
        )
    broken = {(r["table"], r.rule): r.n for r in entry.queries()["dq_rejections"](spark, SMALL).collect()}
    assert broken == {(t, rule): n for t, c in result.silver.items() for rule, n in c.by_rule.items()}


@pytest.mark.parametrize("table", marts.GOLD_TABLES)
def test_gold_equals_the_registered_query(spark, lake, table):
    stored = entry.present(read_layer(spark, lake[0], "gold", table))
    direct = entry.queries()[table](spark, SMALL)
    assert stored.columns == direct.columns
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()


def test_two_kpi_tables_follow_from_sums_of_one_pass(spark, lake, tmp_path):
    stored = {t: read_layer(spark, lake[0], "gold", t) for t in ("dim_machines", *marts.FACT_KEYS)}
    marts.machine_sums(stored["fact_production"]).write.parquet(f"{tmp_path}/sums")
    read = marts.build_kpis(stored["dim_machines"], stored)
    summed = marts.build_kpis(stored["dim_machines"], stored, spark.read.parquet(f"{tmp_path}/sums"))
    assert read.keys() == summed.keys() == set(marts.KPI_TABLES)
    for t in ("kpi_workshop_performance", "kpi_machine_performance"):
        assert not [f for f in summed[t].inputFiles() if "fact_production" in f]
        assert read[t].schema == summed[t].schema
        assert read[t].exceptAll(summed[t]).isEmpty() and summed[t].exceptAll(read[t]).isEmpty()


def test_gold_leaves_no_sums_behind(spark, lake):
    root = Path(lake[0].root)
    assert not [p for p in root.rglob("*") if pipeline.SUMS in p.relative_to(root).parts]


def test_stored_timestamps_are_plain_numbers(lake):
    files = Path(lake[0].path("gold", "fact_alerts")).glob("*.parquet")
    schema = ParquetFile(next(files)).schema
    kinds = {schema.column(i).name: schema.column(i).physical_type for i in range(len(schema.names))}
    assert {kinds[c] for c in ("alert_timestamp", "resolved_at", "_gold_processed_at")} == {"INT64"}


def test_gold_is_validated_and_published(spark, lake):
    layout, result = lake
    assert set(result.gold) == set(marts.GOLD_TABLES)
    assert result.gold == result.validated == result.published
    assert "_gold_processed_at" in read_layer(spark, layout, "served", "dim_sensors").columns


def test_kpi_counts_add_up_to_the_facts(spark, lake):
    layout, result = lake
    daily = read_layer(spark, layout, "gold", "kpi_daily_production")
    assert daily.selectExpr("sum(production_records) as n").first().n == result.gold["fact_production"]
    summary = read_layer(spark, layout, "gold", "kpi_maintenance_summary")
    assert summary.selectExpr("sum(intervention_count) as n").first().n == result.gold["fact_maintenance"]


def test_rejected_rows_can_be_kept(spark, lake):
    layout, result = lake
    pipeline.run_silver(spark, layout, testbed.TIE_BREAKS, keep_rejected=True)
    kept = read_layer(spark, layout, "quarantine", "production")
    assert kept.count() == result.silver["production"].invalid
    assert kept.where("size(violations) = 0").isEmpty()


def test_duplicate_gold_keys_stop_the_chain(spark, tmp_path):
    layout = Layout(str(tmp_path))
    pipeline.run_bronze(spark, layout, testbed.GivenTables(SMALL))
    pipeline.run_silver(spark, layout, testbed.TIE_BREAKS)
    twice = read_layer(spark, layout, "silver", "workshops")
    twice.union(twice).write.parquet(layout.path("other", "workshops"))
    read_layer(spark, layout, "other", "workshops").write.mode("overwrite").parquet(layout.path("silver", "workshops"))
    with pytest.raises(QualityError, match="dim_workshops.workshop_id"):
        pipeline.run_gold(spark, layout)


def test_empty_gold_table_stops_validation(spark, tmp_path, lake):
    layout = Layout(str(tmp_path))
    for t in marts.GOLD_TABLES:
        df = read_layer(spark, lake[0], "gold", t)
        (df.limit(0) if t == "fact_alerts" else df.limit(1)).write.parquet(layout.path("gold", t))
    with pytest.raises(QualityError, match="fact_alerts"):
        pipeline.run_validate(spark, layout)


def test_store_scans_growing_tables_in_ranges():
    from millrace.sources.jdbc import JdbcConnection

    source = pipeline.operational_store(JdbcConnection("jdbc:x", "u", "p"), 32)
    assert source.keys == {"production": "production_id", "maintenance": "maintenance_id", "alerts": "alert_id"}

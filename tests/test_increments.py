"""Facts, partials and KPI tables by increments: equal to a full run, and only what is touched changes."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as entry
import testbed
from millrace.operators.aggregate import Measure, partial_sums
from millrace.plans import increments, marts
from millrace.plans.increments import FACTS, MONTH, PARTIALS, run_increment
from millrace.sources import staging
from millrace.sources.layers import Layout, read_layer
from millrace.sources.staging import publish_checked

COLUMNS = testbed.MAPPINGS["production"]


@pytest.fixture
def lake(spark, layout):
    machines = spark.createDataFrame(
        [(1, "M1", "T", 7, "W7", "here"), (2, "M2", "T", 8, "W8", "there")],
        "machine_id long, machine_name string, machine_type string, workshop_id long, workshop_name string, location string",
    )
    publish_checked(spark, {"dim_machines": machines}, layout, "gold", {})
    return layout


def made(spark, *rows):
    """Raw production rows from (id, machine, date, quantity)."""
    return spark.createDataFrame(
        [(i, m, d, "MORNING", q, 1.0, 2.0, 0.0) for i, m, d, q in rows],
        "production_id long, machine_id long, production_date string, shift string, quantity_produced double,"
        " energy_consumption double, operating_hours double, rejected_quantity double",
    ).selectExpr(
        "production_id", "machine_id", "cast(production_date as date) as production_date", "shift",
        *(f"cast({c} as decimal({p})) as {c}" for c, p in (
            ("quantity_produced", "14,3"), ("energy_consumption", "14,3"), ("operating_hours", "8,2"),
            ("rejected_quantity", "14,3"))),
    )


def files(layout, layer):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{layout.root}/{layer}/fact_production/{MONTH}=*/*.parquet")}


def daily(spark, layout):
    rows = read_layer(spark, layout, "gold", "kpi_daily_production").collect()
    return {(str(r.production_date), r.workshop_id): (float(r.total_quantity_produced), r.production_records) for r in rows}


def keys(spark, layout):
    return sorted(r.production_id for r in read_layer(spark, layout, FACTS, "fact_production").collect())


FIRST = [(1, 1, "2024-01-05", 10.0), (2, 1, "2024-01-06", 20.0), (3, 2, "2024-02-05", 30.0), (4, 2, "2024-03-05", 40.0)]


def test_late_and_corrected_rows(spark, lake):
    assert run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one") == {"fact_production": 4}
    before, sums = files(lake, FACTS), files(lake, PARTIALS)
    # 5 is late for January; 3 moves from February, which it leaves empty, to March.
    late = made(spark, (5, 2, "2024-01-05", 5.0), (3, 2, "2024-03-05", 31.0))
    run_increment(spark, lake, {"production": late}, "two")
    assert daily(spark, lake) == {
        ("2024-01-05", 7): (10.0, 1), ("2024-01-06", 7): (20.0, 1), ("2024-01-05", 8): (5.0, 1), ("2024-03-05", 8): (71.0, 2),
    }
    assert keys(spark, lake) == [1, 2, 3, 4, 5]
    assert not glob.glob(f"{lake.root}/{FACTS}/fact_production/{MONTH}=202402")
    # A load for March leaves January's files alone, in facts and partials.
    january = {p: t for p, t in files(lake, FACTS).items() if "202401" in p}, {p: t for p, t in files(lake, PARTIALS).items() if "202401" in p}
    run_increment(spark, lake, {"production": made(spark, (6, 1, "2024-03-09", 1.0))}, "three")
    after = files(lake, FACTS), files(lake, PARTIALS)
    assert all(later.items() >= earlier.items() for earlier, later in zip(january, after))
    assert before and sums and january[0]


def test_large_loads_move_no_row_to_be_written(spark, lake, monkeypatch):
    """Tasks write their own files of each month, new rows once; staged partitions become live ones as they are."""
    gathered, write = [], increments.write_partitions

    def watched(*a, gather=True, **k):
        gathered.append(gather)
        return write(*a, gather=gather, **k)

    monkeypatch.setattr(increments, "ROWS_A_FILE", 0)
    monkeypatch.setattr(increments, "write_partitions", watched)
    monkeypatch.setattr(staging.layers, "overwrite_partitions", None)
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    late = made(spark, (5, 2, "2024-01-05", 5.0), (3, 2, "2024-03-05", 31.0))
    for _ in range(2):
        run_increment(spark, lake, {"production": late}, "two")
        assert keys(spark, lake) == [1, 2, 3, 4, 5]
        assert daily(spark, lake)["2024-03-05", 8] == (71.0, 2) and ("2024-02-05", 8) not in daily(spark, lake)
    assert gathered and not any(gathered)


@pytest.mark.parametrize("moves", range(6))
def test_a_change_of_partitions_goes_on_where_it_was_lost(spark, lake, monkeypatch, moves):
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    late, move = {"production": made(spark, (5, 2, "2024-01-05", 5.0), (3, 2, "2024-03-05", 31.0))}, staging.Folders.move
    left = [moves]

    def lost(self, source, target):
        # The first move makes the change pending.
        if "/facts/" in target and not left[0]:
            raise KeyboardInterrupt
        left[0] -= "/facts/" in target
        move(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(staging.Folders, "move", lost)
        with pytest.raises(KeyboardInterrupt):
            run_increment(spark, lake, late, "two")
    staging.finish_pending(spark, lake)
    assert keys(spark, lake) == ([1, 2, 3, 4] if moves == 0 else [1, 2, 3, 4, 5])
    run_increment(spark, lake, late, "two")
    assert keys(spark, lake) == [1, 2, 3, 4, 5] and daily(spark, lake)["2024-03-05", 8] == (71.0, 2)


def test_a_refused_correction_leaves_the_row(spark, lake):
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    assert run_increment(spark, lake, {"production": made(spark, (1, 1, "2024-01-05", -1.0))}, "two") == {"fact_production": 0}
    assert daily(spark, lake)["2024-01-05", 7] == (10.0, 1)


def test_a_machine_that_moves_takes_its_history_along(spark, lake):
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    machines = read_layer(spark, lake, "gold", "dim_machines").selectExpr(
        "machine_id", "machine_name", "machine_type", "8L as workshop_id", "'W8' as workshop_name", "location"
    ).collect()
    publish_checked(spark, {"dim_machines": spark.createDataFrame(machines)}, lake, "gold", {})
    increments.refresh_kpis(spark, lake)
    assert {w for _, w in daily(spark, lake)} == {8}


@pytest.mark.parametrize("broken", ["replace", "overwrite", "partials"])
def test_a_load_can_be_repeated_after_a_failure(spark, lake, monkeypatch, broken):
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    late = {"production": made(spark, (5, 2, "2024-01-05", 5.0), (3, 2, "2024-03-05", 31.0))}
    where, what = {
        "replace": (increments, "replace_partitions"),  # before anything has changed
        "overwrite": (staging, "overwrite_partitions"),  # while the facts change
        "partials": (increments, "refresh_partials"),  # between facts and partials
    }[broken]

    def fail(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(where, what, fail)
        with pytest.raises(OSError):
            run_increment(spark, lake, late, "two")
    for _ in range(2):
        run_increment(spark, lake, late, "two")
        assert keys(spark, lake) == [1, 2, 3, 4, 5]
        # February's partial must go though the row has left that month before the second try.
        assert ("2024-02-05", 8) not in daily(spark, lake) and daily(spark, lake)["2024-03-05", 8] == (71.0, 2)


def test_rows_without_a_day_have_a_month_of_their_own(spark, lake):
    fact = marts.fact_production(made(spark, *FIRST).selectExpr("*", "1.0D as quality_rate", "1.0D as energy_per_unit"))
    dateless = fact.selectExpr(*(f"if(production_id = 1, null, {c}) as {c}" if c == "production_date" else c for c in fact.columns))
    for load in ("one", "two"):
        increments.load_fact(spark, lake, "fact_production", dateless, load)
        increments.refresh_partials(spark, lake, "fact_production", load)
        rows = read_layer(spark, lake, PARTIALS, "fact_production").collect()
        assert sorted(r[MONTH] for r in rows) == [0, 202401, 202402, 202403]


def test_touched_months_prune_the_scan(spark, lake):
    run_increment(spark, lake, {"production": made(spark, *FIRST)}, "one")
    plan = plan_of(read_layer(spark, lake, FACTS, "fact_production").where(f"{MONTH} in (202401, 202403)"))
    assert f"PartitionFilters: [{MONTH}" in plan and "DataFilters: []" in plan


def test_measures_of_one_name_must_agree(spark):
    df = spark.range(3).selectExpr("id as k", "id as a", "id as b")
    with pytest.raises(ValueError):
        partial_sums(df, ["k"], [Measure("x", "sum", "a"), Measure("x", "sum", "b")])


def test_increments_equal_a_full_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    entry.loaded(spark, SMALL, layout, ["production", "maintenance", "alerts"])
    for t in marts.KPI_TABLES:
        got, want = entry.present(read_layer(spark, layout, "gold", t)), entry.queries()[t](spark, SMALL)
        assert sorted(got.columns) == sorted(want.columns)
        got = got.select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), t

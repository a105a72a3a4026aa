"""Contract rules on single rows: what is kept, what is dropped, and why."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from millrace.plans.contract import accept, clean, quarantine, standardised
from millrace.plans.tables import (
    ALERTS,
    MACHINES,
    MAINTENANCE,
    OPERATIONAL_TABLES,
    PRODUCTION,
    SENSOR_EVENTS,
    SENSORS,
    TECHNICIANS,
    WORKSHOPS,
)

SCHEMAS = {
    "workshops": "workshop_id int, workshop_name string, location string, description string",
    "machines": "machine_id int, machine_name string, machine_type string, workshop_id int, status string,"
    " manufacturer string",
    "technicians": "technician_id int, first_name string, last_name string, specialty string, email string,"
    " phone string",
    "sensors": "sensor_id int, sensor_code string, machine_id int, sensor_type string, measurement_unit string,"
    " minimum_threshold decimal(12,3), maximum_threshold decimal(12,3), status string",
    "production": "production_id bigint, machine_id int, production_date date, shift string,"
    " quantity_produced decimal(14,3), energy_consumption decimal(14,3), operating_hours decimal(8,2),"
    " rejected_quantity decimal(14,3)",
    "maintenance": "maintenance_id bigint, machine_id int, technician_id int, maintenance_type string,"
    " start_time timestamp, end_time timestamp, description string, cost decimal(14,2), status string",
    "alerts": "alert_id bigint, sensor_id int, machine_id int, alert_timestamp timestamp, alert_type string,"
    " severity string, measured_value decimal(14,3), threshold_value decimal(14,3), message string,"
    " status string, resolved_at timestamp",
    "sensor_events": "event_id string, sensor_id int, machine_id int, sensor_type string, value double,"
    " unit string, event_timestamp timestamp",
}
T0 = datetime(2024, 5, 1, 8, 0, 0)
GOOD = {
    "workshops": dict(workshop_id=1, workshop_name=" main hall ", location="north-west wing", description=" d "),
    "machines": dict(machine_id=1, machine_name=" cr-1", machine_type="jaw crusher", workshop_id=1,
                     status=" active ", manufacturer="ACME works"),
    "technicians": dict(technician_id=1, first_name=" ada", last_name="Byron", specialty="HYDRAULICS",
                        email=" Ada@X.org ", phone=" 06 "),
    "sensors": dict(sensor_id=1, sensor_code=" t-1", machine_id=1, sensor_type="temperature",
                    measurement_unit=" C ", minimum_threshold=D("1"), maximum_threshold=D("2"), status="faulty"),
    "production": dict(production_id=1, machine_id=1, production_date=date(2024, 5, 1), shift=" night",
                       quantity_produced=D("8"), energy_consumption=D("4"), operating_hours=D("7.5"),
                       rejected_quantity=D("2")),
    "maintenance": dict(maintenance_id=1, machine_id=1, technician_id=1, maintenance_type="preventive",
                        start_time=T0, end_time=T0, description=" x ", cost=D("1"), status="planned"),
    "alerts": dict(alert_id=1, sensor_id=1, machine_id=1, alert_timestamp=T0, alert_type="hot", severity="low",
                   measured_value=D("1"), threshold_value=D("1"), message=" m ", status="open", resolved_at=None),
    "sensor_events": dict(event_id="e", sensor_id=1, machine_id=1, sensor_type=" energy ", value=1.0, unit=" W ",
                          event_timestamp=T0),
}
ALL = {**OPERATIONAL_TABLES, "sensor_events": SENSOR_EVENTS}


def frame(spark, table, *changes):
    names = [c.split()[0] for c in SCHEMAS[table].replace("decimal(", "decimal_").split(", ")]
    names = [n for n in names if n in GOOD[table]]
    rows = [tuple({**GOOD[table], **c}[n] for n in names) for c in (changes or ({},))]
    return spark.createDataFrame(rows, SCHEMAS[table])


def kept(spark, table, **change):
    return accept(frame(spark, table, change), ALL[table]).collect()


@pytest.mark.parametrize("table", list(ALL))
def test_good_row_is_kept(spark, table):
    assert len(kept(spark, table)) == 1


@pytest.mark.parametrize("table", list(ALL))
def test_each_required_column_rejects_null(spark, table):
    df = frame(spark, table, *({c: None} for c in ALL[table].required))
    assert accept(df, ALL[table]).count() == 0
    found = {v for r in quarantine_without_dedup(df, table) for v in r["violations"]}
    assert {f"required:{c}" for c in ALL[table].required} <= found


def quarantine_without_dedup(df, table):
    tidy = standardised(df, ALL[table])
    return tidy.selectExpr("*", f"{ALL[table].violations()} as violations").collect()


@pytest.mark.parametrize(
    "table, change",
    [
        ("production", {"quantity_produced": None}),
        ("production", {"energy_consumption": None}),
        ("production", {"operating_hours": None}),
        ("production", {"rejected_quantity": None}),
        ("production", {"shift": None}),
        ("production", {"shift": "swing"}),
        ("production", {"quantity_produced": D("-1"), "rejected_quantity": D("-1")}),
        ("production", {"energy_consumption": D("-0.001")}),
        ("production", {"operating_hours": D("24.01")}),
        ("production", {"rejected_quantity": D("8.001")}),
        ("machines", {"status": None}),
        ("machines", {"status": "broken"}),
        ("machines", {"status": "\tACTIVE"}),
        ("sensors", {"sensor_type": "humidity"}),
        ("sensors", {"minimum_threshold": D("2")}),
        ("maintenance", {"cost": None}),
        ("maintenance", {"cost": D("-1")}),
        ("maintenance", {"end_time": datetime(2024, 5, 1, 7, 59, 59)}),
        ("maintenance", {"maintenance_type": "unknown"}),
        ("alerts", {"severity": "fatal"}),
        ("alerts", {"status": None}),
        ("alerts", {"resolved_at": datetime(2024, 5, 1, 7, 59, 59)}),
        ("sensor_events", {"sensor_type": "temperature", "value": 180.1}),
        ("sensor_events", {"sensor_type": "temperature", "value": float("nan")}),
        ("sensor_events", {"sensor_type": "vibration", "value": -0.1}),
        ("sensor_events", {"sensor_type": "pressure", "value": 40.5}),
        ("sensor_events", {"sensor_type": "humidity"}),
        ("sensor_events", {"sensor_type": None}),
    ],
)
def test_rejected(spark, table, change):
    assert kept(spark, table, **change) == []


@pytest.mark.parametrize(
    "table, change",
    [
        ("production", {"operating_hours": D("0")}),
        ("production", {"operating_hours": D("24")}),
        ("production", {"rejected_quantity": D("8")}),
        ("maintenance", {"end_time": None}),
        ("maintenance", {"status": "cancelled"}),
        ("alerts", {"resolved_at": T0}),
        ("sensors", {"minimum_threshold": None}),
        ("sensors", {"maximum_threshold": None}),
        ("workshops", {"workshop_name": "  "}),
        ("sensor_events", {"sensor_type": "temperature", "value": -20.0}),
        ("sensor_events", {"sensor_type": "Temperature ", "value": 180.0}),
        ("sensor_events", {"sensor_type": "vibration", "value": 50.0}),
        ("sensor_events", {"sensor_type": "pressure", "value": 0.0}),
        ("sensor_events", {"sensor_type": "energy", "value": 2000.0}),
    ],
)
def test_accepted(spark, table, change):
    assert len(kept(spark, table, **change)) == 1


def test_standardised_text(spark):
    (w,) = kept(spark, "workshops")
    assert (w.workshop_name, w.location, w.description) == ("Main Hall", "North-west Wing", "d")
    (m,) = kept(spark, "machines")
    assert (m.machine_name, m.machine_type, m.status, m.manufacturer) == ("CR-1", "Jaw Crusher", "ACTIVE", "Acme Works")
    (t,) = kept(spark, "technicians")
    assert (t.first_name, t.last_name, t.specialty, t.email, t.phone) == ("Ada", "BYRON", "Hydraulics", "ada@x.org", "06")
    (s,) = kept(spark, "sensors")
    assert (s.sensor_code, s.sensor_type, s.measurement_unit, s.status) == ("T-1", "TEMPERATURE", "C", "FAULTY")
    (e,) = kept(spark, "sensor_events")
    assert (e.sensor_type, e.unit) == ("ENERGY", "W")
    assert kept(spark, "workshops", workshop_name="  ")[0].workshop_name == ""


def test_ratios(spark):
    (p,) = kept(spark, "production")
    assert (p.quality_rate, p.energy_per_unit) == (D("0.75"), D("0.5"))
    (zero,) = kept(spark, "production", quantity_produced=D("0"), rejected_quantity=D("0"))
    assert zero.quality_rate is None and zero.energy_per_unit is None


def test_dedup_comes_before_the_rules(spark):
    df = frame(spark, "production", {"shift": "swing", "machine_id": 1}, {"shift": "night", "machine_id": 2})
    assert clean(df, PRODUCTION, ("machine_id",)).count() == 0
    (lost,) = quarantine(df, PRODUCTION, ("machine_id",)).collect()
    assert lost.violations == ["domain:shift"]
    assert [r.machine_id for r in clean(df, PRODUCTION, ("shift",)).collect()] == [2]


def test_violations_name_every_broken_rule(spark):
    df = frame(spark, "maintenance", {"cost": None, "status": "x", "end_time": datetime(2020, 1, 1)})
    (row,) = quarantine(df, MAINTENANCE).collect()
    assert row.violations == ["domain:status", "range:cost", "cross:end_not_before_start"]


def test_rules_cover_the_declared_model():
    assert [c.name for c in (WORKSHOPS, MACHINES, TECHNICIANS, SENSORS, PRODUCTION, MAINTENANCE, ALERTS)] == list(
        OPERATIONAL_TABLES
    )
    assert sum(len(c.references) for c in OPERATIONAL_TABLES.values()) == 7
    assert sum(len(c.domains) for c in OPERATIONAL_TABLES.values()) == 8
    order = list(OPERATIONAL_TABLES)
    for c in OPERATIONAL_TABLES.values():
        assert all(order.index(r.table) < order.index(c.name) for r in c.references)

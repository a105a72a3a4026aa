"""The serving model: four dimensions, three facts, four KPI tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.functions.expressions import elapsed_hours, flag, one_of
from millrace.operators.aggregate import (
    Measure,
    merge_partials,
    partial_sums,
    source_types,
    summarise,
    summarise_enriched,
)
from millrace.operators.enrich import enrich

# Tables, keys, columns and measures of the serving model, here and in the functions below.
DIMENSION_KEYS = {
    "dim_workshops": "workshop_id",
    "dim_machines": "machine_id",
    "dim_technicians": "technician_id",
    "dim_sensors": "sensor_id",
}
FACT_KEYS = {
    "fact_production": "production_id",
    "fact_maintenance": "maintenance_id",
    "fact_alerts": "alert_id",
}
KPI_TABLES = (
    "kpi_daily_production",
    "kpi_workshop_performance",
    "kpi_machine_performance",
    "kpi_maintenance_summary",
)
GOLD_TABLES = (*DIMENSION_KEYS, *FACT_KEYS, *KPI_TABLES)

# What the KPI tables know about a machine.
MACHINE_ATTRIBUTES = ("machine_name", "machine_type", "workshop_id", "workshop_name", "location")

DAILY_PRODUCTION = (
    Measure("total_quantity_produced", "sum", "quantity_produced", 3),
    Measure("total_accepted_quantity", "sum", "accepted_quantity", 3),
    Measure("total_rejected_quantity", "sum", "rejected_quantity", 3),
    Measure("total_energy_consumption", "sum", "energy_consumption", 3),
    Measure("average_quality_rate", "avg", "quality_rate", 4),
    Measure("average_energy_per_unit", "avg", "energy_per_unit", 4),
    Measure("production_records", "count", "production_id"),
)
WORKSHOP_PERFORMANCE = (
    Measure("total_production", "sum", "quantity_produced", 3),
    Measure("total_rejected", "sum", "rejected_quantity", 3),
    Measure("total_energy", "sum", "energy_consumption", 3),
    Measure("average_quality_rate", "avg", "quality_rate", 4),
    Measure("average_energy_per_unit", "avg", "energy_per_unit", 4),
    Measure("average_operating_hours", "avg", "operating_hours", 2),
)
MACHINE_PRODUCTION = (
    Measure("total_production", "sum", "quantity_produced", 3),
    Measure("total_energy", "sum", "energy_consumption", 3),
    Measure("average_quality_rate", "avg", "quality_rate", 4),
    Measure("average_energy_per_unit", "avg", "energy_per_unit", 4),
    Measure("total_operating_hours", "sum", "operating_hours", 2),
)
MACHINE_MAINTENANCE = (
    Measure("maintenance_count", "count", "maintenance_id"),
    Measure("total_maintenance_cost", "sum", "cost", 2),
    Measure("average_maintenance_duration_hours", "avg", "duration_hours", 2),
)
MACHINE_ALERTS = (
    Measure("alert_count", "count", "alert_id"),
    Measure("critical_alert_count", "sum", "is_critical"),
    Measure("average_alert_resolution_hours", "avg", "resolution_hours", 2),
)
MAINTENANCE_SUMMARY = (
    Measure("intervention_count", "count", "maintenance_id"),
    Measure("total_cost", "sum", "cost", 2),
    Measure("average_duration_hours", "avg", "duration_hours", 2),
    Measure("minimum_duration_hours", "min", "duration_hours", 2),
    Measure("maximum_duration_hours", "max", "duration_hours", 2),
)


def dim_workshops(workshops: DataFrame) -> DataFrame:
    return workshops.selectExpr("workshop_id", "workshop_name", "location", "description")


def dim_machines(machines: DataFrame, workshops: DataFrame) -> DataFrame:
    return enrich(machines, workshops, "workshop_id", ("workshop_name", "location")).selectExpr(
        "machine_id",
        "machine_name",
        "machine_type",
        "manufacturer",
        "installation_date",
        "status",
        "workshop_id",
        "workshop_name",
        "location",
    )


def dim_technicians(technicians: DataFrame) -> DataFrame:
    return technicians.selectExpr(
        "technician_id", "first_name", "last_name", "specialty", "email", "phone", "hire_date"
    )


def dim_sensors(sensors: DataFrame, machines: DataFrame) -> DataFrame:
    """``machines`` is the machine dimension, which carries the workshop along."""
    return enrich(sensors, machines, "machine_id", ("machine_name", "workshop_id", "workshop_name")).selectExpr(
        "sensor_id",
        "sensor_code",
        "sensor_type",
        "measurement_unit",
        "minimum_threshold",
        "maximum_threshold",
        "status",
        "installation_date",
        "machine_id",
        "machine_name",
        "workshop_id",
        "workshop_name",
    )


def build_dimensions(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    machines = dim_machines(silver["machines"], silver["workshops"])
    return {
        "dim_workshops": dim_workshops(silver["workshops"]),
        "dim_machines": machines,
        "dim_technicians": dim_technicians(silver["technicians"]),
        "dim_sensors": dim_sensors(silver["sensors"], machines),
    }


def fact_production(production: DataFrame) -> DataFrame:
    return production.selectExpr(
        "production_id",
        "machine_id",
        "production_date",
        "shift",
        "quantity_produced",
        "rejected_quantity",
        "energy_consumption",
        "operating_hours",
        "quality_rate",
        "energy_per_unit",
        "quantity_produced - rejected_quantity as accepted_quantity",
        "year(production_date) as production_year",
        "month(production_date) as production_month",
    )


def fact_maintenance(maintenance: DataFrame) -> DataFrame:
    return maintenance.selectExpr(
        "maintenance_id",
        "machine_id",
        "technician_id",
        "maintenance_type",
        "start_time",
        "end_time",
        "description",
        "cost",
        "status",
        "to_date(start_time) as maintenance_date",
        f"{elapsed_hours('start_time', 'end_time')} as duration_hours",
    )


def fact_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.selectExpr(
        "alert_id",
        "sensor_id",
        "machine_id",
        "alert_timestamp",
        "alert_type",
        "severity",
        "measured_value",
        "threshold_value",
        "message",
        "status",
        "resolved_at",
        "to_date(alert_timestamp) as alert_date",
        f"{elapsed_hours('alert_timestamp', 'resolved_at')} as resolution_hours",
        f"{flag(one_of('severity', ['CRITICAL']))} as is_critical",
    )


def build_facts(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fact_production": fact_production(silver["production"]),
        "fact_maintenance": fact_maintenance(silver["maintenance"]),
        "fact_alerts": fact_alerts(silver["alerts"]),
    }


def kpi_daily_production(production: DataFrame, machines: DataFrame) -> DataFrame:
    return summarise_enriched(
        production,
        machines,
        "machine_id",
        ["production_date"],
        ["workshop_id", "workshop_name"],
        DAILY_PRODUCTION,
    )


def kpi_workshop_performance(production: DataFrame, machines: DataFrame) -> DataFrame:
    return summarise_enriched(
        production,
        machines,
        "machine_id",
        [],
        ["workshop_id", "workshop_name", "location"],
        WORKSHOP_PERFORMANCE,
    )


def kpi_machine_performance(
    production: DataFrame, maintenance: DataFrame, alerts: DataFrame, machines: DataFrame
) -> DataFrame:
    """Driven by production: a machine without production is absent.

    All three facts are summed up per machine before anything is joined, so every join is between
    one-row-per-machine frames that are already partitioned by machine.
    """
    return _machine_performance(
        summarise(production, ["machine_id"], MACHINE_PRODUCTION),
        summarise(maintenance, ["machine_id"], MACHINE_MAINTENANCE),
        summarise(alerts, ["machine_id"], MACHINE_ALERTS),
        machines,
    )


def _machine_performance(
    production: DataFrame, maintenance: DataFrame, alerts: DataFrame, machines: DataFrame
) -> DataFrame:
    """From the totals of each machine."""
    attributes = [c for c in MACHINE_ATTRIBUTES if c != "location"]
    totals = (
        enrich(production, machines, "machine_id", attributes)
        .join(maintenance, "machine_id", "left")
        .join(alerts, "machine_id", "left")
    )
    zero_filled = ["maintenance_count", "total_maintenance_cost", "alert_count", "critical_alert_count"]
    ordered = ["machine_id", *attributes]
    ordered += [m.alias for m in (*MACHINE_PRODUCTION, *MACHINE_MAINTENANCE, *MACHINE_ALERTS)]
    return totals.fillna(0, subset=zero_filled).selectExpr(*ordered)


def kpi_maintenance_summary(maintenance: DataFrame, machines: DataFrame) -> DataFrame:
    keys = ["maintenance_date", "maintenance_type", "status"]
    workshop = ["workshop_id", "workshop_name"]
    summary = summarise_enriched(
        maintenance, machines, "machine_id", keys, workshop, MAINTENANCE_SUMMARY
    )
    return _ordered_summary(summary)


def _ordered_summary(summary: DataFrame) -> DataFrame:
    keys = ["maintenance_date", "workshop_id", "workshop_name", "maintenance_type", "status"]
    return summary.selectExpr(*keys, *(m.alias for m in MAINTENANCE_SUMMARY))


def machine_reference(machines: DataFrame) -> DataFrame:
    """The machine columns the KPI tables join."""
    return machines.selectExpr("machine_id", *MACHINE_ATTRIBUTES)


def machine_sums(production: DataFrame) -> DataFrame:
    """A row for every machine that produced, from which two KPI tables follow without the fact."""
    return partial_sums(production, ["machine_id"], (*MACHINE_PRODUCTION, *WORKSHOP_PERFORMANCE))


def build_kpis(
    machines: DataFrame, facts: Mapping[str, DataFrame], sums: DataFrame | None = None
) -> dict[str, DataFrame]:
    """``sums`` are stored :func:`machine_sums`; without them two more tables read the production fact themselves."""
    reference = machine_reference(machines)
    production, maintenance, alerts = facts["fact_production"], facts["fact_maintenance"], facts["fact_alerts"]
    kpis = {
        "kpi_daily_production": kpi_daily_production(production, reference),
        "kpi_maintenance_summary": kpi_maintenance_summary(maintenance, reference),
    }
    if sums is None:
        return kpis | {
            "kpi_workshop_performance": kpi_workshop_performance(production, reference),
            "kpi_machine_performance": kpi_machine_performance(production, maintenance, alerts, reference),
        }
    workshop, sources = ["workshop_id", "workshop_name", "location"], source_types(production)
    placed = enrich(sums, reference, "machine_id", workshop)
    return kpis | {
        "kpi_workshop_performance": merge_partials(placed, workshop, WORKSHOP_PERFORMANCE, sources),
        "kpi_machine_performance": _machine_performance(
            merge_partials(sums, ["machine_id"], MACHINE_PRODUCTION, sources),
            summarise(maintenance, ["machine_id"], MACHINE_MAINTENANCE),
            summarise(alerts, ["machine_id"], MACHINE_ALERTS),
            reference,
        ),
    }


@dataclass(frozen=True)
class Partials:
    """What is stored of a fact so that its KPI tables need not be recomputed: sums a day, machine and more."""

    day: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]


FACT_PARTIALS = {
    "fact_production": Partials(
        "production_date",
        ("production_date", "machine_id"),
        (*DAILY_PRODUCTION, *WORKSHOP_PERFORMANCE, *MACHINE_PRODUCTION),
    ),
    "fact_maintenance": Partials(
        "maintenance_date",
        ("maintenance_date", "machine_id", "maintenance_type", "status"),
        (*MACHINE_MAINTENANCE, *MAINTENANCE_SUMMARY),
    ),
    "fact_alerts": Partials("alert_date", ("alert_date", "machine_id"), MACHINE_ALERTS),
}


def kpis_from_partials(
    machines: DataFrame, partials: Mapping[str, DataFrame], sources: Mapping[str, Mapping[str, T.DataType]]
) -> dict[str, DataFrame]:
    """The KPI tables :func:`build_kpis` gives, as far as there are partials for them.

    Machine attributes are joined to the partials, so a machine that has moved to another workshop takes its history
    along, as it does when everything is recomputed.
    """
    reference, found = machine_reference(machines), {}

    def merged(fact: str, keys: list[str], attributes: list[str], measures: tuple[Measure, ...]) -> DataFrame:
        rows = enrich(partials[fact], reference, "machine_id", attributes) if attributes else partials[fact]
        return merge_partials(rows, [*keys, *attributes], measures, sources[fact])

    workshop = ["workshop_id", "workshop_name"]
    if "fact_production" in partials:
        found["kpi_daily_production"] = merged("fact_production", ["production_date"], workshop, DAILY_PRODUCTION)
        found["kpi_workshop_performance"] = merged(
            "fact_production", [], [*workshop, "location"], WORKSHOP_PERFORMANCE
        )
    if "fact_maintenance" in partials:
        keys = ["maintenance_date", "maintenance_type", "status"]
        found["kpi_maintenance_summary"] = _ordered_summary(
            merged("fact_maintenance", keys, workshop, MAINTENANCE_SUMMARY)
        )
    if partials.keys() == FACT_PARTIALS.keys():
        found["kpi_machine_performance"] = _machine_performance(
            merged("fact_production", ["machine_id"], [], MACHINE_PRODUCTION),
            merged("fact_maintenance", ["machine_id"], [], MACHINE_MAINTENANCE),
            merged("fact_alerts", ["machine_id"], [], MACHINE_ALERTS),
            reference,
        )
    return found

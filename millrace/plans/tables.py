"""The contracts of the seven operational tables and of the sensor event stream."""

from __future__ import annotations

from millrace.functions.expressions import (
    guarded_ratio,
    literal,
    lower_trimmed,
    title_trimmed,
    trimmed,
    unless_null,
    upper_trimmed,
    within,
)
from millrace.plans.contract import Reference, TableContract

# The codes each column may hold.
MACHINE_STATUS = ("ACTIVE", "INACTIVE", "MAINTENANCE")
SENSOR_TYPE = ("TEMPERATURE", "VIBRATION", "PRESSURE", "ENERGY")
SENSOR_STATUS = ("ACTIVE", "INACTIVE", "FAULTY")
SHIFT = ("MORNING", "AFTERNOON", "NIGHT")
MAINTENANCE_TYPE = ("PREVENTIVE", "CORRECTIVE", "EMERGENCY")
MAINTENANCE_STATUS = ("PLANNED", "IN_PROGRESS", "COMPLETED", "CANCELLED")
ALERT_SEVERITY = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ALERT_STATUS = ("OPEN", "ACKNOWLEDGED", "RESOLVED")
# Inclusive measuring range per sensor type.
EVENT_RANGES = {
    "TEMPERATURE": (-20.0, 180.0),
    "VIBRATION": (0.0, 50.0),
    "PRESSURE": (0.0, 40.0),
    "ENERGY": (0.0, 2000.0),
}


def value_in_type_range() -> str:
    """The bounds that go with the row's sensor type; unknown types have none and fail."""
    cases = (f"when {literal(t)} then {within('value', *bounds)}" for t, bounds in EVENT_RANGES.items())
    return f"case sensor_type {' '.join(cases)} end"


# Columns, keys and rules of the operational tables and the event payload.
WORKSHOPS = TableContract(
    name="workshops",
    key="workshop_id",
    required=("workshop_id", "workshop_name"),
    standardise={"workshop_name": title_trimmed, "location": title_trimmed, "description": trimmed},
)

MACHINES = TableContract(
    name="machines",
    key="machine_id",
    required=("machine_id", "machine_name", "workshop_id"),
    standardise={
        "machine_name": upper_trimmed,
        "machine_type": title_trimmed,
        "status": upper_trimmed,
        "manufacturer": title_trimmed,
    },
    domains={"status": MACHINE_STATUS},
    references=(Reference("workshop_id", "workshops"),),
)

TECHNICIANS = TableContract(
    name="technicians",
    key="technician_id",
    required=("technician_id", "first_name", "last_name"),
    standardise={
        "first_name": title_trimmed,
        "last_name": upper_trimmed,
        "specialty": title_trimmed,
        "email": lower_trimmed,
        "phone": trimmed,
    },
)

SENSORS = TableContract(
    name="sensors",
    key="sensor_id",
    required=("sensor_id", "machine_id", "sensor_code"),
    standardise={
        "sensor_code": upper_trimmed,
        "sensor_type": upper_trimmed,
        "measurement_unit": trimmed,
        "status": upper_trimmed,
    },
    domains={"sensor_type": SENSOR_TYPE, "status": SENSOR_STATUS},
    cross={
        "minimum_below_maximum": unless_null(
            ("minimum_threshold", "maximum_threshold"), "minimum_threshold < maximum_threshold"
        )
    },
    references=(Reference("machine_id", "machines"),),
)

PRODUCTION = TableContract(
    name="production",
    key="production_id",
    required=("production_id", "machine_id", "production_date"),
    standardise={"shift": upper_trimmed},
    domains={"shift": SHIFT},
    ranges={
        "quantity_produced": (0, None),
        "energy_consumption": (0, None),
        "operating_hours": (0, 24),
        "rejected_quantity": (0, None),
    },
    cross={"rejected_within_produced": "rejected_quantity <= quantity_produced"},
    derived={
        "quality_rate": guarded_ratio("quantity_produced - rejected_quantity", "quantity_produced"),
        "energy_per_unit": guarded_ratio("energy_consumption", "quantity_produced"),
    },
    references=(Reference("machine_id", "machines"),),
)

MAINTENANCE = TableContract(
    name="maintenance",
    key="maintenance_id",
    required=("maintenance_id", "machine_id", "technician_id", "start_time"),
    standardise={"maintenance_type": upper_trimmed, "status": upper_trimmed, "description": trimmed},
    domains={"maintenance_type": MAINTENANCE_TYPE, "status": MAINTENANCE_STATUS},
    ranges={"cost": (0, None)},
    cross={"end_not_before_start": unless_null(("end_time",), "end_time >= start_time")},
    references=(Reference("machine_id", "machines"), Reference("technician_id", "technicians")),
)

ALERTS = TableContract(
    name="alerts",
    key="alert_id",
    required=("alert_id", "sensor_id", "machine_id", "alert_timestamp"),
    standardise={
        "alert_type": upper_trimmed,
        "severity": upper_trimmed,
        "status": upper_trimmed,
        "message": trimmed,
    },
    domains={"severity": ALERT_SEVERITY, "status": ALERT_STATUS},
    cross={"resolved_not_before_alert": unless_null(("resolved_at",), "resolved_at >= alert_timestamp")},
    references=(Reference("sensor_id", "sensors"), Reference("machine_id", "machines")),
)

SENSOR_EVENTS = TableContract(
    name="sensor_events",
    key="event_id",
    required=("event_id", "sensor_id", "machine_id", "event_timestamp", "value"),
    standardise={"sensor_type": upper_trimmed, "unit": trimmed},
    domains={"sensor_type": SENSOR_TYPE},
    cross={"value_in_type_range": value_in_type_range()},
)

# Parents come before their children.
OPERATIONAL_TABLES = {
    c.name: c for c in (WORKSHOPS, MACHINES, TECHNICIANS, SENSORS, PRODUCTION, MAINTENANCE, ALERTS)
}

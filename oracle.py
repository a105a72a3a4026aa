"""The registered queries once more, as stand-alone SQL over the given tables.

Written apart from the Spark code: plain common table expressions, one statement per query. Only the fixture
mapping (what the test tables stand for) is shared.
"""

from __future__ import annotations

from testbed import MAPPINGS, TIE_BREAKS, select_list

KEYS = {
    "workshops": "workshop_id",
    "machines": "machine_id",
    "technicians": "technician_id",
    "sensors": "sensor_id",
    "production": "production_id",
    "maintenance": "maintenance_id",
    "alerts": "alert_id",
}

REFERENCES = [
    ("machines", "workshop_id", "workshops", "workshop_id"),
    ("sensors", "machine_id", "machines", "machine_id"),
    ("production", "machine_id", "machines", "machine_id"),
    ("maintenance", "machine_id", "machines", "machine_id"),
    ("maintenance", "technician_id", "technicians", "technician_id"),
    ("alerts", "sensor_id", "sensors", "sensor_id"),
    ("alerts", "machine_id", "machines", "machine_id"),
]


def shift(ts: str, milliseconds: str) -> str:
    return f"({ts} + to_milliseconds({milliseconds}))"


def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '),"
        f" lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _up(x: str) -> str:
    return f"upper(trim({x}))"


# Standardised columns per table; everything else passes through.
TIDY = {
    "workshops": {
        "workshop_name": _initcap("workshop_name"),
        "location": _initcap("location"),
        "description": "trim(description)",
    },
    "machines": {
        "machine_name": _up("machine_name"),
        "machine_type": _initcap("machine_type"),
        "status": _up("status"),
        "manufacturer": _initcap("manufacturer"),
    },
    "technicians": {
        "first_name": _initcap("first_name"),
        "last_name": _up("last_name"),
        "specialty": _initcap("specialty"),
        "email": "lower(trim(email))",
        "phone": "trim(phone)",
    },
    "sensors": {
        "sensor_code": _up("sensor_code"),
        "sensor_type": _up("sensor_type"),
        "measurement_unit": "trim(measurement_unit)",
        "status": _up("status"),
    },
    "production": {"shift": _up("shift")},
    "maintenance": {
        "maintenance_type": _up("maintenance_type"),
        "status": _up("status"),
        "description": "trim(description)",
    },
    "alerts": {
        "alert_type": _up("alert_type"),
        "severity": _up("severity"),
        "status": _up("status"),
        "message": "trim(message)",
    },
}


def _domain(column: str, *values: str) -> tuple[str, str]:
    return f"domain:{column}", f"{column} in ({', '.join(repr(v) for v in values)})"


def _required(*columns: str) -> list[tuple[str, str]]:
    return [(f"required:{c}", f"{c} is not null") for c in columns]


SENSOR_TYPES = ("TEMPERATURE", "VIBRATION", "PRESSURE", "ENERGY")

RULES = {
    "workshops": _required("workshop_id", "workshop_name"),
    "machines": [
        *_required("machine_id", "machine_name", "workshop_id"),
        _domain("status", "ACTIVE", "INACTIVE", "MAINTENANCE"),
    ],
    "technicians": _required("technician_id", "first_name", "last_name"),
    "sensors": [
        *_required("sensor_id", "machine_id", "sensor_code"),
        _domain("sensor_type", *SENSOR_TYPES),
        _domain("status", "ACTIVE", "INACTIVE", "FAULTY"),
        (
            "cross:minimum_below_maximum",
            "minimum_threshold is null or maximum_threshold is null or minimum_threshold < maximum_threshold",
        ),
    ],
    "production": [
        *_required("production_id", "machine_id", "production_date"),
        _domain("shift", "MORNING", "AFTERNOON", "NIGHT"),
        ("range:quantity_produced", "quantity_produced >= 0"),
        ("range:energy_consumption", "energy_consumption >= 0"),
        ("range:operating_hours", "operating_hours >= 0 and operating_hours <= 24"),
        ("range:rejected_quantity", "rejected_quantity >= 0"),
        ("cross:rejected_within_produced", "rejected_quantity <= quantity_produced"),
    ],
    "maintenance": [
        *_required("maintenance_id", "machine_id", "technician_id", "start_time"),
        _domain("maintenance_type", "PREVENTIVE", "CORRECTIVE", "EMERGENCY"),
        _domain("status", "PLANNED", "IN_PROGRESS", "COMPLETED", "CANCELLED"),
        ("range:cost", "cost >= 0"),
        ("cross:end_not_before_start", "end_time is null or end_time >= start_time"),
    ],
    "alerts": [
        *_required("alert_id", "sensor_id", "machine_id", "alert_timestamp"),
        _domain("severity", "LOW", "MEDIUM", "HIGH", "CRITICAL"),
        _domain("status", "OPEN", "ACKNOWLEDGED", "RESOLVED"),
        ("cross:resolved_not_before_alert", "resolved_at is null or resolved_at >= alert_timestamp"),
    ],
}


def _ok(rule: str) -> str:
    return f"coalesce({rule}, false)"


def _all_rules(table: str) -> str:
    return " and ".join(_ok(rule) for _, rule in RULES[table])


# --- common table expressions: name -> (tables it needs, body) ------------------------------------------------


def _bronze(table: str) -> str:
    origin, _ = MAPPINGS[table]
    return f"select {', '.join(select_list(table, shift))} from {origin}"


def _ranked(table: str) -> str:
    order = [f"{c} asc nulls first" for c in TIE_BREAKS.get(table, ())] or [KEYS[table]]
    return (
        f"select *, row_number() over (partition by {KEYS[table]} order by {', '.join(order)}) as copy_rank"
        f" from bronze_{table}"
    )


def _flagged(table: str) -> str:
    tidy = ", ".join(f"{sql} as {c}" for c, sql in TIDY[table].items())
    return (
        f"select *, ({_all_rules(table)}) as is_valid"
        f" from (select * replace ({tidy}) from ranked_{table}) t"
    )


def _quotient(numerator: str) -> str:
    """Of two decimals with three digits, in whole units of the 18th digit, rounded half up; both are >= 0."""
    n, d = f"cast(({numerator}) * 1000 as hugeint)", "cast(quantity_produced * 1000 as hugeint)"
    return f"case when quantity_produced > 0 then (2 * {n} * 1000000000000000000::hugeint + {d}) // (2 * {d}) end"


def _silver(table: str) -> str:
    ratios = ""
    if table == "production":
        ratios = (
            f", {_quotient('quantity_produced - rejected_quantity')} as quality_rate"
            f", {_quotient('energy_consumption')} as energy_per_unit"
        )
    return f"select * exclude (copy_rank, is_valid){ratios} from flagged_{table} where copy_rank = 1 and is_valid"


def _hours(start: str, end: str) -> str:
    return f"(epoch_us({end}) // 1000000 - epoch_us({start}) // 1000000) / 3600.0::double"


CTES: dict[str, tuple[list[str], str]] = {}
for _t in KEYS:
    CTES[f"bronze_{_t}"] = ([], _bronze(_t))
    CTES[f"ranked_{_t}"] = ([f"bronze_{_t}"], _ranked(_t))
    CTES[f"flagged_{_t}"] = ([f"ranked_{_t}"], _flagged(_t))
    CTES[f"silver_{_t}"] = ([f"flagged_{_t}"], _silver(_t))

CTES["dim_workshops"] = (
    ["silver_workshops"],
    "select workshop_id, workshop_name, location, description from silver_workshops",
)
CTES["dim_machines"] = (
    ["silver_machines", "silver_workshops"],
    "select machine_id, machine_name, machine_type, manufacturer, installation_date, status, m.workshop_id,"
    " workshop_name, location from silver_machines m left join silver_workshops w"
    " on m.workshop_id = w.workshop_id",
)
CTES["dim_technicians"] = (
    ["silver_technicians"],
    "select technician_id, first_name, last_name, specialty, email, phone, hire_date from silver_technicians",
)
CTES["dim_sensors"] = (
    ["silver_sensors", "dim_machines"],
    "select sensor_id, sensor_code, sensor_type, measurement_unit, minimum_threshold, maximum_threshold,"
    " s.status, s.installation_date, s.machine_id, machine_name, workshop_id, workshop_name"
    " from silver_sensors s left join dim_machines m on s.machine_id = m.machine_id",
)
CTES["fact_production"] = (
    ["silver_production"],
    "select production_id, machine_id, production_date, shift, quantity_produced, rejected_quantity,"
    " energy_consumption, operating_hours, quality_rate, energy_per_unit,"
    " quantity_produced - rejected_quantity as accepted_quantity,"
    " cast(year(production_date) as integer) as production_year,"
    " cast(month(production_date) as integer) as production_month from silver_production",
)
CTES["fact_maintenance"] = (
    ["silver_maintenance"],
    "select maintenance_id, machine_id, technician_id, maintenance_type, start_time, end_time, description,"
    " cost, status, cast(start_time as date) as maintenance_date,"
    f" {_hours('start_time', 'end_time')} as duration_hours from silver_maintenance",
)
CTES["fact_alerts"] = (
    ["silver_alerts"],
    "select alert_id, sensor_id, machine_id, alert_timestamp, alert_type, severity, measured_value,"
    " threshold_value, message, status, resolved_at, cast(alert_timestamp as date) as alert_date,"
    f" {_hours('alert_timestamp', 'resolved_at')} as resolution_hours,"
    " case when severity = 'CRITICAL' then 1 else 0 end as is_critical from silver_alerts",
)


def _mean(total: str, n: str, digits: int) -> str:
    """Integers divided, with ``digits`` more digits, rounded half up."""
    return f"((2 * ({total}) * {10**digits}::hugeint + ({n})) // (2 * ({n})))"


def _ratio_avg(column: str) -> str:
    """Averages of ratios have 22 digits before they are rounded to four."""
    at_22 = _mean(f"cast(sum({column}) as hugeint)", f"count({column})", 4)
    return f"cast(({at_22} + {5 * 10**17}::hugeint) // {10**18}::hugeint as double) / 10000"


def _decimal_avg(column: str) -> str:
    """Averages of decimals with two digits have six before they are rounded to two."""
    at_6 = _mean(f"cast(sum({column}) * 100 as hugeint)", f"count({column})", 4)
    return f"cast(({at_6} + 5000) // 10000 as double) / 100"


def _sum(column: str) -> str:
    return f"cast(sum({column}) as double)"


def _hour_stat(function: str, column: str) -> str:
    """Hours are whole seconds / 3600."""
    seconds = f"cast(round({column} * 3600) as hugeint)"
    if function == "avg":
        total, n = f"cast(sum({seconds}) as hugeint)", f"(3600 * count({column}))"
    else:
        total, n = f"{function}({seconds})", "3600"
    return f"cast({_mean(total, n, 2)} as double) / 100"


CTES["kpi_daily_production"] = (
    ["fact_production", "dim_machines"],
    "select production_date, workshop_id, workshop_name,"
    f" {_sum('quantity_produced')} as total_quantity_produced,"
    f" {_sum('accepted_quantity')} as total_accepted_quantity,"
    f" {_sum('rejected_quantity')} as total_rejected_quantity,"
    f" {_sum('energy_consumption')} as total_energy_consumption,"
    f" {_ratio_avg('quality_rate')} as average_quality_rate,"
    f" {_ratio_avg('energy_per_unit')} as average_energy_per_unit,"
    " count(production_id) as production_records"
    " from fact_production p left join dim_machines m on p.machine_id = m.machine_id group by 1, 2, 3",
)
CTES["kpi_workshop_performance"] = (
    ["fact_production", "dim_machines"],
    "select workshop_id, workshop_name, location,"
    f" {_sum('quantity_produced')} as total_production,"
    f" {_sum('rejected_quantity')} as total_rejected,"
    f" {_sum('energy_consumption')} as total_energy,"
    f" {_ratio_avg('quality_rate')} as average_quality_rate,"
    f" {_ratio_avg('energy_per_unit')} as average_energy_per_unit,"
    f" {_decimal_avg('operating_hours')} as average_operating_hours"
    " from fact_production p left join dim_machines m on p.machine_id = m.machine_id group by 1, 2, 3",
)
CTES["kpi_machine_performance"] = (
    ["fact_production", "fact_maintenance", "fact_alerts", "dim_machines"],
    "select p.*, coalesce(maintenance_count, 0) as maintenance_count,"
    " coalesce(total_maintenance_cost, 0) as total_maintenance_cost, average_maintenance_duration_hours,"
    " coalesce(alert_count, 0) as alert_count, coalesce(critical_alert_count, 0) as critical_alert_count,"
    " average_alert_resolution_hours from ("
    "select p.machine_id, machine_name, machine_type, workshop_id, workshop_name,"
    f" {_sum('quantity_produced')} as total_production, {_sum('energy_consumption')} as total_energy,"
    f" {_ratio_avg('quality_rate')} as average_quality_rate,"
    f" {_ratio_avg('energy_per_unit')} as average_energy_per_unit,"
    f" {_sum('operating_hours')} as total_operating_hours"
    " from fact_production p left join dim_machines m on p.machine_id = m.machine_id group by 1, 2, 3, 4, 5) p"
    " left join (select machine_id, count(maintenance_id) as maintenance_count,"
    f" {_sum('cost')} as total_maintenance_cost,"
    f" {_hour_stat('avg', 'duration_hours')} as average_maintenance_duration_hours"
    " from fact_maintenance group by 1) k on p.machine_id = k.machine_id"
    " left join (select machine_id, count(alert_id) as alert_count,"
    " cast(sum(is_critical) as bigint) as critical_alert_count,"
    f" {_hour_stat('avg', 'resolution_hours')} as average_alert_resolution_hours"
    " from fact_alerts group by 1) a on p.machine_id = a.machine_id",
)
CTES["kpi_maintenance_summary"] = (
    ["fact_maintenance", "dim_machines"],
    "select maintenance_date, workshop_id, workshop_name, maintenance_type, f.status,"
    f" count(maintenance_id) as intervention_count, {_sum('cost')} as total_cost,"
    f" {_hour_stat('avg', 'duration_hours')} as average_duration_hours,"
    f" {_hour_stat('min', 'duration_hours')} as minimum_duration_hours,"
    f" {_hour_stat('max', 'duration_hours')} as maximum_duration_hours"
    " from fact_maintenance f left join dim_machines m on f.machine_id = m.machine_id group by 1, 2, 3, 4, 5",
)

CTES["records"] = ([], _bronze("sensor_records"))
CTES["bronze_sensor_events"] = (
    ["records"],
    "select kafka_key, raw_value, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,"
    " j->>'event_id' as event_id, cast(j->>'sensor_id' as integer) as sensor_id,"
    " cast(j->>'machine_id' as integer) as machine_id, j->>'sensor_type' as sensor_type,"
    " cast(j->>'value' as double) as value, j->>'unit' as unit,"
    " cast(replace(j->>'event_timestamp', '+00:00', '') as timestamp) as event_timestamp"
    " from (select *, case when raw_value = 'not json' then null else raw_value::json end as j from records) t",
)
CTES["silver_sensor_events"] = (
    ["bronze_sensor_events"],
    "select kafka_key, kafka_topic, kafka_partition, kafka_timestamp, event_id, sensor_id, machine_id,"
    " upper(trim(sensor_type)) as sensor_type, value, trim(unit) as unit, event_timestamp,"
    " 'VALID' as _data_quality_status from bronze_sensor_events"
    " where event_id is not null and sensor_id is not null and machine_id is not null"
    " and event_timestamp is not null and value is not null and case upper(trim(sensor_type))"
    " when 'TEMPERATURE' then value between -20 and 180 when 'VIBRATION' then value between 0 and 50"
    " when 'PRESSURE' then value between 0 and 40 when 'ENERGY' then value between 0 and 2000 else false end"
    " qualify row_number() over (partition by event_id, event_timestamp order by kafka_offset) = 1",
)


def _with(needs: list[str], final: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for parent in CTES[name][0]:
            visit(parent)
        ordered.append(name)

    for name in needs:
        visit(name)
    # Parents are materialised once however many expressions read them.
    return "with " + ", ".join(f"{n} as materialized ({CTES[n][1]})" for n in ordered) + " " + final


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


# Decimal columns leave as doubles; ratios, kept in units of the 18th digit, are rounded to nine.
_PRODUCTION_OUT = (
    "* replace (cast(quantity_produced as double) as quantity_produced,"
    " cast(energy_consumption as double) as energy_consumption,"
    " cast(operating_hours as double) as operating_hours,"
    " cast(rejected_quantity as double) as rejected_quantity"
)
_RATIOS_OUT = "".join(
    f", cast(({c} + 500000000) // 1000000000 as double) / 1000000000 as {c}" for c in ("quality_rate", "energy_per_unit")
)
OUTPUTS = {
    "bronze_production": _PRODUCTION_OUT
    + "), 'testbed' as _source_system, 'production' as _source_table, 'run' as _ingestion_id",
    "silver_production": _PRODUCTION_OUT + _RATIOS_OUT + ")",
    "fact_production": _PRODUCTION_OUT + _RATIOS_OUT + ", cast(accepted_quantity as double) as accepted_quantity)",
    "silver_sensors": "* replace (cast(minimum_threshold as double) as minimum_threshold,"
    " cast(maximum_threshold as double) as maximum_threshold)",
    "dim_sensors": "* replace (cast(minimum_threshold as double) as minimum_threshold,"
    " cast(maximum_threshold as double) as maximum_threshold)",
    "silver_maintenance": "* replace (cast(cost as double) as cost)",
    "fact_maintenance": "* replace (cast(cost as double) as cost)",
    "silver_alerts": "* replace (cast(measured_value as double) as measured_value,"
    " cast(threshold_value as double) as threshold_value)",
    "fact_alerts": "* replace (cast(measured_value as double) as measured_value,"
    " cast(threshold_value as double) as threshold_value)",
}

GOLD = [
    "dim_workshops",
    "dim_machines",
    "dim_technicians",
    "dim_sensors",
    "fact_production",
    "fact_maintenance",
    "fact_alerts",
    "kpi_daily_production",
    "kpi_workshop_performance",
    "kpi_machine_performance",
    "kpi_maintenance_summary",
]


def _select(name: str) -> str:
    return _with([name], f"select {OUTPUTS.get(name, '*')} from {name}")


def _row_counts() -> str:
    parts = [
        f"select '{t}' as \"table\", count(*) as bronze, count(*) filter (copy_rank > 1) as duplicates,"
        f" count(*) filter (copy_rank = 1 and not is_valid) as invalid,"
        f" count(*) filter (copy_rank = 1 and is_valid) as silver from flagged_{t}"
        for t in KEYS
    ]
    counts = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ("bronze", "duplicates", "invalid", "silver"))
    each = _union(parts)
    return _with([f"flagged_{t}" for t in KEYS], f"{each} union all select 'total' as \"table\", {counts} from ({each}) t")


def _rejections() -> str:
    parts = [
        f"select '{t}' as \"table\", '{name}' as rule, count(*) filter (not {_ok(rule)}) as n"
        f" from flagged_{t} where copy_rank = 1"
        for t in KEYS
        for name, rule in RULES[t]
    ]
    return _with([f"flagged_{t}" for t in KEYS], _union(parts))


def _duplicates() -> str:
    parts = [
        f"select '{t}' as \"table\", count(*) filter (copies > 1) as keys,"
        f" cast(sum(copies - 1) as bigint) as extra_rows,"
        f" count(*) filter (any_valid and not winner_valid) as keys_lost from (select {key},"
        f" count(*) as copies, bool_or(is_valid) as any_valid,"
        f" bool_or(is_valid and copy_rank = 1) as winner_valid from flagged_{t} group by 1) g"
        for t, key in KEYS.items()
    ]
    return _with([f"flagged_{t}" for t in KEYS], _union(parts))


def _orphans() -> str:
    parts = [
        f"select '{child}' as child, '{column}' as \"column\", '{parent}' as parent, count(*) as n"
        f" from silver_{child} c where {column} is not null"
        f" and not exists (select 1 from silver_{parent} p where p.{key} = c.{column})"
        for child, column, parent, key in REFERENCES
    ]
    return _with([f"silver_{t}" for t in KEYS], _union(parts))


def _key_uniqueness() -> str:
    keyed = dict(zip(GOLD, KEYS.values()))
    parts = [
        f"select '{t}' as \"table\", count(*) as rows,"
        f" count(distinct {key}) + cast(coalesce(bool_or({key} is null), false) as bigint) as keys from {t}"
        for t, key in keyed.items()
    ]
    return _with(list(keyed), _union(parts))


def _column_names(table: str) -> list[str]:
    return [e.rsplit(" as ", 1)[-1] for e in MAPPINGS[table][1]]


def _completeness() -> str:
    parts = [
        f"select '{t}' as \"table\", '{c}' as \"column\", count(*) - count({c}) as nulls from bronze_{t}"
        for t in KEYS
        for c in _column_names(t)
    ]
    return _with([f"bronze_{t}" for t in KEYS], _union(parts))


# What a stored table is summed up by.
MEASURES = {
    **KEYS,
    **dict(zip(GOLD, KEYS.values())),
    "kpi_daily_production": "production_records",
    "kpi_workshop_performance": "workshop_id",
    "kpi_machine_performance": "alert_count",
    "kpi_maintenance_summary": "intervention_count",
}


def _batch() -> str:
    layers = [("bronze", t, f"bronze_{t}") for t in KEYS] + [("silver", t, f"silver_{t}") for t in KEYS]
    layers += [("gold", t, t) for t in GOLD]
    parts = [
        f"select '{layer}' as layer, '{t}' as \"table\", count(*) as rows,"
        f" cast(coalesce(sum({MEASURES[t]}), 0) as bigint) as measure, cast(0 as bigint) as unstamped from {cte}"
        for layer, t, cte in layers
    ]
    return _with([cte for _, _, cte in layers], _union(parts))


EVENT_RULES = [
    *_required("event_id", "sensor_id", "machine_id", "event_timestamp", "value"),
    ("domain:sensor_type", f"upper(trim(sensor_type)) in {SENSOR_TYPES}"),
    (
        "cross:value_in_type_range",
        "case upper(trim(sensor_type)) when 'TEMPERATURE' then value between -20 and 180 when 'VIBRATION' then"
        " value between 0 and 50 when 'PRESSURE' then value between 0 and 40 when 'ENERGY' then value between 0 and"
        " 2000 end",
    ),
]


def _staged_publication() -> str:
    """The refused run shows what the run before it has published."""
    parts = [
        f"select {step} as step, {refused} as refused, count(*) as rows,"
        f" cast(coalesce(sum(production_id), 0) as bigint) as keys from fact_production{kept}"
        for step, refused, kept in (
            (1, "false", " where production_date < '1998-01-01'"),
            (2, "true", " where production_date < '1998-01-01'"),
            (3, "false", ""),
        )
    ]
    return _with(["fact_production"], _union(parts))


def _stream_quality() -> str:
    valid = " and ".join(_ok(rule) for _, rule in EVENT_RULES)
    parts = [
        "select 'rows' as what, count(*) as n from bronze_sensor_events",
        "select 'accepted' as what, count(*) as n from silver_sensor_events",
        f"select 'copies' as what, count(*) filter ({valid}) - (select count(*) from silver_sensor_events) as n"
        " from bronze_sensor_events",
        *(
            f"select 'refused {label}' as what, count(*) filter (not {_ok(rule)}) as n from bronze_sensor_events"
            for label, rule in EVENT_RULES
        ),
    ]
    return _with(["bronze_sensor_events", "silver_sensor_events"], _union(parts))


def _stream_accounts() -> str:
    valid = " and ".join(_ok(rule) for _, rule in EVENT_RULES)
    return _with(
        ["bronze_sensor_events", "silver_sensor_events"],
        "select count(*) as rows, (select count(*) from silver_sensor_events) as accepted,"
        f" count(*) filter (not ({valid})) as refused, 0::bigint as late,"
        f" count(*) filter ({valid}) - (select count(*) from silver_sensor_events) as copies from bronze_sensor_events",
    )


def _refused_events() -> str:
    broken = ", ".join(f"case when not {_ok(rule)} then '{label}' end" for label, rule in EVENT_RULES)
    listed = f"array_to_string(list_filter([{broken}], lambda x: x is not null), ',')"
    return _with(
        ["bronze_sensor_events"],
        f"select * from (select kafka_partition, kafka_offset, raw_value, {listed} as violations"
        " from bronze_sensor_events) t where violations <> ''",
    )


def _late(final: str) -> str:
    """Valid events of the second drain that lie ten minutes or more before the newest valid event of the first."""
    valid = " and ".join(_ok(rule) for _, rule in EVENT_RULES)
    first = f"(select * from bronze_sensor_events where {valid} and kafka_offset % 10 < 8)"
    known = f"select 1 from {first} a where a.event_id = e.event_id and a.event_timestamp = e.event_timestamp"
    fates = (
        "select kafka_partition, kafka_offset, kafka_timestamp, event_id, event_timestamp,"
        f" upper(trim(sensor_type)) as sensor_type, value, case when exists ({known}) then 'copy' else 'lost' end as fate"
        f" from bronze_sensor_events e where {valid} and kafka_offset % 10 >= 8"
        f" and event_timestamp <= (select max(event_timestamp) - interval 10 minute from {first} f)"
    )
    return _with(["bronze_sensor_events"], final.format(fates=f"({fates}) l"))


def _stream_completeness() -> str:
    fields = "raw_value event_id sensor_id machine_id sensor_type value unit event_timestamp".split()
    parts = ["select 'rows' as what, count(*) as n from bronze_sensor_events"]
    parts += [f"select '{c}' as what, count(*) filter ({c} is null) as n from bronze_sensor_events" for c in fields]
    return _with(["bronze_sensor_events"], _union(parts))


def _insert_if_absent() -> str:
    return _with(
        ["silver_sensors", "bronze_alerts"],
        "select sensor_id, sensor_code, machine_id, status from silver_sensors union all"
        " select distinct sensor_id, 'UNREGISTERED-' || cast(sensor_id as varchar) as sensor_code, machine_id,"
        " 'INACTIVE' as status from bronze_alerts a"
        " where not exists (select 1 from silver_sensors s where s.sensor_id = a.sensor_id)",
    )


def oracle_sql() -> dict[str, str]:
    statements = {
        name: _select(name)
        for name in [
            "bronze_production",
            "bronze_sensor_events",
            *(f"silver_{t}" for t in KEYS),
            "silver_sensor_events",
            *GOLD,
        ]
    }
    statements["dq_row_counts"] = _row_counts()
    statements["dq_rejections"] = _rejections()
    statements["dq_duplicates"] = _duplicates()
    statements["dq_orphans"] = _orphans()
    statements["dq_key_uniqueness"] = _key_uniqueness()
    statements["dq_completeness"] = _completeness()
    gold = _union([f"select '{t}' as \"table\", count(*) as rows from {t}" for t in GOLD])
    every = f"select 'total' as \"table\", cast(sum(rows) as bigint) as rows from ({gold}) t"
    statements["gold_row_counts"] = _with(GOLD, f"{gold} union all {every}")
    statements["latest_events"] = _with(
        ["bronze_sensor_events"],
        "select event_id, sensor_id, machine_id, sensor_type, value, unit, event_timestamp, kafka_partition,"
        " kafka_offset from bronze_sensor_events order by kafka_timestamp desc, kafka_topic desc,"
        " kafka_partition desc, kafka_offset desc limit 10",
    )
    statements["insert_if_absent"] = _insert_if_absent()
    statements["layer_round_trip"] = statements["fact_production"]
    statements["batch_pipeline"] = _batch()
    for kpi in ("daily_production", "workshop_performance", "maintenance_summary", "machine_performance"):
        statements[f"incremental_{kpi}"] = statements[f"kpi_{kpi}"]
    statements["incremental_fact_production"] = statements["fact_production"]
    statements["colocated_machine_performance"] = statements["kpi_machine_performance"]
    statements["colocated_key_uniqueness"] = statements["dq_key_uniqueness"]
    statements["staged_publication"] = _staged_publication()
    statements["stored_insert_if_absent"] = statements["insert_if_absent"]
    statements["stream_quality"] = _stream_quality()
    statements["stream_progress"] = _with(
        ["records"],
        "select 6::bigint as batches, 0::bigint as missing_batches, count(*) as input_rows, 0::bigint as late_rows"
        " from records",
    )
    statements["stream_accounts"] = _stream_accounts()
    statements["refused_events"] = _refused_events()
    statements["late_events"] = _late(
        "select kafka_partition, kafka_offset, event_id, event_timestamp, sensor_type, value, fate from {fates}"
    )
    statements["late_keys"] = _late(
        "select event_id, event_timestamp, count(*) as records, min(kafka_timestamp) as first_arrival,"
        " max(kafka_timestamp) as last_arrival from {fates} where fate = 'lost' group by event_id, event_timestamp"
    )
    newest = statements["latest_events"]
    statements["newest_by_day"] = newest
    statements["stream_completeness"] = _stream_completeness()
    statements["stream_report"] = newest.replace(
        "kafka_offset from bronze_sensor_events order",
        "kafka_offset, (select count(*) from bronze_sensor_events) as total_rows from bronze_sensor_events order",
    )
    return statements

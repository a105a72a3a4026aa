"""The given test tables projected onto the operational tables and the event topic.

Each mapping is a plain select list, valid in Spark SQL and in the oracle's dialect but for timestamp shifts.
It plants what real feeds contain: copies, padded and mixed case, broken rules, missing options, orphans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Shift = Callable[[str, str], str]


def spark_shift(ts: str, milliseconds: str) -> str:
    return f"timestampadd(MILLISECOND, {milliseconds}, {ts})"


# Select lists of the fixture mapping. {+a|b} stands for timestamp a moved by b milliseconds.
MAPPINGS: dict[str, tuple[str, list[str]]] = {
    "workshops": (
        "nation left join region on n_regionkey = r_regionkey",
        [
            "n_nationkey as workshop_id",
            "'  ' || n_name || ' PLANT ' as workshop_name",
            "lower(r_name) as location",
            "' site ' || r_name as description",
        ],
    ),
    "machines": (
        "supplier",
        [
            "s_suppkey as machine_id",
            "' ' || lower(s_name) as machine_name",
            "case s_suppkey % 3 when 0 then 'CRUSHER' when 1 then 'packaging machine ' else 'Dryer' end"
            " as machine_type",
            "s_nationkey as workshop_id",
            "cast('2018-03-15' as date) as installation_date",
            "case when s_acctbal < 0 then 'broken' when s_acctbal < 1000 then ' maintenance'"
            " when s_acctbal < 2000 then 'inactive' else 'Active ' end as status",
            "'smart PACKAGING' as manufacturer",
        ],
    ),
    "technicians": (
        "customer",
        [
            "c_custkey as technician_id",
            "' tech' as first_name",
            "lower(c_name) as last_name",
            "c_mktsegment as specialty",
            "upper(c_name) || '@X.LOCAL ' as email",
            "case when c_custkey % 5 = 0 then null else ' 06' || cast(c_custkey as varchar(20)) end as phone",
            "cast('2019-07-15' as date) as hire_date",
        ],
    ),
    "sensors": (
        "part",
        [
            "p_partkey as sensor_id",
            "lower(p_brand) || '-' || cast(p_partkey as varchar(20)) as sensor_code",
            "p_partkey % 80 as machine_id",
            "case p_size % 5 when 0 then 'temperature' when 1 then ' Vibration' when 2 then 'PRESSURE'"
            " when 3 then 'energy' else 'humidity' end as sensor_type",
            "' bar ' as measurement_unit",
            "case when p_size = 7 then null else cast(p_size as decimal(12,3)) end as minimum_threshold",
            "cast(25.5 as decimal(12,3)) as maximum_threshold",
            "case p_partkey % 4 when 0 then 'FAULTY' when 1 then 'inactive' else 'active' end as status",
            "cast('2022-01-10' as date) as installation_date",
        ],
    ),
    "production": (
        "lineitem",
        [
            "l_orderkey * 10 + l_linenumber as production_id",
            "l_suppkey as machine_id",
            "cast(l_shipdate as date) as production_date",
            "case when l_linenumber = 7 then 'swing' when l_returnflag = 'A' then ' morning '"
            " when l_returnflag = 'N' then 'Afternoon' else 'NIGHT' end as shift",
            "cast(l_quantity - 1 as decimal(14,3)) as quantity_produced",
            "cast(l_extendedprice as decimal(14,3)) as energy_consumption",
            "cast(cast(l_tax as decimal(4,2)) * 320 as decimal(8,2)) as operating_hours",
            "cast(cast(l_quantity - 1 as decimal(14,3)) * cast(l_discount as decimal(4,2)) as decimal(14,3))"
            " as rejected_quantity",
            "l_partkey",
            "l_shipdate",
            "l_linestatus",
        ],
    ),
    "maintenance": (
        "orders",
        [
            "o_orderkey as maintenance_id",
            "o_custkey % 80 as machine_id",
            "o_custkey as technician_id",
            "case when o_orderpriority = '1-URGENT' then 'emergency' when o_orderpriority = '5-LOW'"
            " then ' preventive' when o_orderpriority = '4-NOT SPECIFIED' then 'unknown' else 'CORRECTIVE' end"
            " as maintenance_type",
            "o_orderdate as start_time",
            "case when o_orderkey % 97 = 0 then {+o_orderdate|-1000} when o_orderstatus = 'F' then"
            " {+o_orderdate|(o_orderkey % 48 + 1) * 3600000 + o_orderkey % 1000} end as end_time",
            "' routine ' as description",
            "cast(o_totalprice as decimal(14,2)) as cost",
            "case o_orderstatus when 'F' then 'completed' when 'O' then 'Planned' else 'IN_PROGRESS ' end"
            " as status",
        ],
    ),
    "alerts": (
        "events",
        [
            "event_id as alert_id",
            "user_id as sensor_id",
            "user_id % 80 as machine_id",
            "ts as alert_timestamp",
            "event_type || '_threshold' as alert_type",
            "case event_type when 'click' then 'low' when 'view' then 'Medium' when 'signup' then ' HIGH'"
            " when 'error' then 'critical' else 'fatal' end as severity",
            "cast(value as decimal(14,3)) as measured_value",
            "cast(100 as decimal(14,3)) as threshold_value",
            "' over limit ' as message",
            "case event_id % 3 when 0 then 'open' when 1 then 'ACKNOWLEDGED' else 'resolved' end as status",
            "case when event_id % 89 = 0 then {+ts|-5000} when event_id % 3 = 2 then"
            " {+ts|(event_id % 72 + 1) * 3600000 + event_id % 1000} end as resolved_at",
        ],
    ),
    "sensor_records": (
        "(select *, 0 as copy from events union all select *, 1 as copy from events where event_id % 50 = 1)"
        " x",
        [
            "cast(user_id % 80 as varchar(20)) as kafka_key",
            "case when event_id % 101 = 0 then 'not json' else '{\"event_id\":\"e-'"
            " || cast(event_id as varchar(20)) || '\",\"sensor_id\":' || cast(user_id as varchar(20))"
            " || ',\"machine_id\":' || case when event_id % 67 = 0 then 'null'"
            " else cast(user_id % 80 as varchar(20)) end || ',\"sensor_type\":\"' || case event_type"
            " when 'click' then ' temperature' when 'view' then 'Vibration' when 'signup' then 'PRESSURE'"
            " when 'error' then 'energy ' else 'humidity' end || '\",\"value\":'"
            " || cast(cast(value as decimal(14,2)) as varchar(20)) || ',\"unit\":\" u \",\"event_timestamp\":\"'"
            " || replace(cast(ts as varchar(30)), ' ', 'T') || '+00:00\"}' end as raw_value",
            "'sensor-readings' as kafka_topic",
            "cast(user_id % 3 as int) as kafka_partition",
            "event_id * 2 + copy as kafka_offset",
            "ts as kafka_timestamp",
        ],
    ),
}

# Order in which copies of a key are preferred; unlisted tables have no copies.
TIE_BREAKS = {
    "production": (
        "l_shipdate",
        "l_partkey",
        "machine_id",
        "energy_consumption",
        "quantity_produced",
        "rejected_quantity",
        "operating_hours",
        "shift",
        "l_linestatus",
    )
}


# Columns a store would deliver with their time zone.
ZONED = {"start_time", "end_time", "alert_timestamp", "resolved_at", "kafka_timestamp"}


def select_list(table: str, shift: Shift) -> list[str]:
    """The mapping's expressions with its timestamp shifts written in one dialect."""
    return [_shifted(expression, shift) for expression in MAPPINGS[table][1]]


def spark_select_list(table: str) -> list[str]:
    selected = []
    for expression in select_list(table, spark_shift):
        value, _, alias = expression.rpartition(" as ")
        selected.append(f"cast({value} as timestamp) as {alias}" if alias in ZONED else expression)
    return selected


def _shifted(expression: str, shift: Shift) -> str:
    head, *rest = expression.split("{+")
    for part in rest:
        inner, tail = part.split("}", 1)
        head += shift(*inner.split("|")) + tail
    return head


# Column types of the given tables; stating them spares a job that reads footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _origin(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table == "workshops":
        nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    if table == "sensor_records":
        copies = "explode(if(event_id % 50 = 1, array(0, 1), array(0))) as copy"
        return given(spark, sf_dir, "events").selectExpr("*", copies)
    return given(spark, sf_dir, MAPPINGS[table][0])


def operational(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One operational table as a store would deliver it, timestamps zoned."""
    return _origin(spark, sf_dir, table).selectExpr(*spark_select_list(table))


def sensor_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event topic in Kafka's record layout."""
    return operational(spark, sf_dir, "sensor_records").selectExpr(
        "cast(kafka_key as binary) as key",
        "cast(raw_value as binary) as value",
        "kafka_topic as topic",
        "kafka_partition as partition",
        "kafka_offset as offset",
        "kafka_timestamp as timestamp",
    )


@dataclass(frozen=True)
class GivenTables:
    """A source for the Bronze layer that reads the test tables instead of a store."""

    sf_dir: str
    system: str = "testbed"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return operational(spark, self.sf_dir, table)


LOADS = 2
# Columns of first versions that are wrong: moved by forty days, or doubled.
WRONG = {
    "production": (("production_date",), "energy_consumption"),
    "maintenance": (("start_time", "end_time"), "cost"),
    "alerts": (("alert_timestamp", "resolved_at"), "measured_value"),
}


def loads(raw: DataFrame, table: str, key: str) -> list[DataFrame]:
    """The rows of an operational table as they might arrive in two loads.

    By a hash of the key, so that copies stay together: six tenths are right at once, some of them sent again; two
    tenths come wrong first and are corrected by the second load, the rest is late. Rows without a key are in the first.
    """
    moved, doubled = WRONG[table]
    kinds = dict(raw.dtypes)
    wrong = {c: f"cast({c} + interval 40 days as {kinds[c]})" for c in moved}
    wrong[doubled] = f"cast({doubled} * 2 as {kinds[doubled]})"
    dealt = raw.selectExpr("*", f"if({key} is null, 0L, pmod(xxhash64({key}), 10)) as part")
    first = dealt.where("part < 8").selectExpr(
        *(f"if(part >= 6, {wrong[c]}, {c}) as {c}" if c in wrong else c for c in raw.columns)
    )
    return [first, dealt.where("part >= 5").drop("part")]

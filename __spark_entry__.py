
from __future__ import annotations

import os
import sys
from collections.abc import Callable, Mapping
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import oracle
import testbed
from millrace.operators import quality
from millrace.operators.enrich import orphans
from millrace.operators.insert import append_new
from millrace.operators.dedupe import dedupe
from millrace.plans import increments, marts, pipeline
from millrace.plans.contract import clean, standardised
from millrace.plans.tables import OPERATIONAL_TABLES
from millrace.session import prepare, scratch_folder
from millrace.sources import layers
from millrace.sources.bucketed import read_bucketed, write_bucketed
from millrace.sources.layers import Layout, read_layer, write_checked, write_layer
from millrace.sources.staging import publish_checked
from millrace.streaming import events
from millrace.streaming.events import RECORD_SCHEMA, BatchProgress, bronze_events

ENTRY_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]
# Partitions of the event stream's dedup state, fixed by its first start.
STATE_PARTITIONS = 8
# Micro-batches of the drain whose progress is looked at.
BATCHES = 6


def present(df: DataFrame) -> DataFrame:
    """What leaves a query: no run-time stamps, decimals as doubles, timestamps without zone."""
    out = []
    for f in df.schema.fields:
        value = f"`{f.name}`"
        if f.name.startswith("_") and f.name.endswith(("_at", "_timestamp")):
            continue
        if isinstance(f.dataType, T.DecimalType):
            value = f"cast({f'round({value}, 9)' if f.dataType.scale > 9 else value} as double)"
        elif isinstance(f.dataType, T.TimestampType):
            value = f"cast({value} as timestamp_ntz)"
        out.append(f"{value} as `{f.name}`")
    return df.selectExpr(*out)


class SilverTables(Mapping):
    """Silver frames of one data set, each put together when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = silver(self._spark, self._sf_dir, table)
        return self._built[table]

    def __iter__(self):
        return iter(OPERATIONAL_TABLES)

    def __len__(self) -> int:
        return len(OPERATIONAL_TABLES)


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return testbed.operational(spark, sf_dir, table)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    contract = OPERATIONAL_TABLES[table]
    return clean(bronze(spark, sf_dir, table), contract, testbed.TIE_BREAKS.get(table, ()))


def gold_keyed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = SilverTables(spark, sf_dir)
    return {**marts.build_dimensions(tables), **marts.build_facts(tables)}


def bronze_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.stamp_bronze(bronze(spark, sf_dir, "production"), "testbed", "production", "run")


def drained_events(spark: SparkSession, sf_dir: str) -> Layout:
    """Records in a folder, drained into streaming Bronze and from there into streaming Silver."""
    layout = Layout(scratch_folder(spark, "events"))
    write_layer(testbed.sensor_records(spark, sf_dir), layout, "topic", "records")
    records = spark.readStream.schema(RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(records, layout, drain=True).awaitTermination()
    schema = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE).schema
    silver_stream = pipeline.start_silver_stream(spark, layout, schema, drain=True, state_partitions=STATE_PARTITIONS)
    silver_stream.awaitTermination()
    return layout


def silver_sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = drained_events(spark, sf_dir)
    # Which of several copies arrives first is not defined, so what tells copies apart is left out.
    return read_layer(spark, layout, pipeline.SILVER_EVENTS, pipeline.EVENT_TABLE).drop("raw_value", "kafka_offset")


def dim_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_machines(silver(spark, sf_dir, "machines"), silver(spark, sf_dir, "workshops"))


def dim_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_sensors(silver(spark, sf_dir, "sensors"), dim_machines(spark, sf_dir))


def _from_silver(build: Callable[[DataFrame], DataFrame], table: str) -> Query:
    return lambda spark, sf_dir: build(silver(spark, sf_dir, table))


fact_production = _from_silver(marts.fact_production, "production")
fact_maintenance = _from_silver(marts.fact_maintenance, "maintenance")
fact_alerts = _from_silver(marts.fact_alerts, "alerts")


def kpi_daily_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    machines = marts.machine_reference(dim_machines(spark, sf_dir))
    return marts.kpi_daily_production(fact_production(spark, sf_dir), machines)


def kpi_workshop_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    machines = marts.machine_reference(dim_machines(spark, sf_dir))
    return marts.kpi_workshop_performance(fact_production(spark, sf_dir), machines)


def kpi_machine_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_machine_performance(
        fact_production(spark, sf_dir),
        fact_maintenance(spark, sf_dir),
        fact_alerts(spark, sf_dir),
        dim_machines(spark, sf_dir),
    )


def kpi_maintenance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    machines = marts.machine_reference(dim_machines(spark, sf_dir))
    return marts.kpi_maintenance_summary(fact_maintenance(spark, sf_dir), machines)


def stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = drained_events(spark, sf_dir)
    came, kept = (
        read_layer(spark, layout, layer, pipeline.EVENT_TABLE)
        for layer in (pipeline.BRONZE_EVENTS, pipeline.SILVER_EVENTS)
    )
    return pipeline.stream_quality(came, kept)


def judged_drain(spark: SparkSession, sf_dir: str) -> tuple[Layout, int]:
    """Records drained into Bronze and from there into the table of both verdicts; late rows of the second drain."""
    layout, listener = Layout(scratch_folder(spark, "events")), BatchProgress()
    write_layer(testbed.sensor_records(spark, sf_dir), layout, "topic", "records")
    records = spark.readStream.schema(RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(records, layout, drain=True).awaitTermination()
    schema = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE).schema
    query = pipeline.start_judged_stream(
        spark, layout, schema, drain=True, state_partitions=STATE_PARTITIONS, listener=listener
    )
    pipeline.follow_stream(spark, layout, pipeline.JUDGED_EVENTS, query, listener)
    return layout, pipeline.stream_status(spark, layout, pipeline.JUDGED_EVENTS).first()["late_rows"]


def stream_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, late = judged_drain(spark, sf_dir)
    came, judged = (
        read_layer(spark, layout, layer, pipeline.EVENT_TABLE)
        for layer in (pipeline.BRONZE_EVENTS, pipeline.JUDGED_EVENTS)
    )
    return pipeline.stream_accounts(came, judged, late)


def refused_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refused events of the stream with the rules they broke."""
    layout, _ = judged_drain(spark, sf_dir)
    rows = read_layer(spark, layout, pipeline.JUDGED_EVENTS, pipeline.EVENT_TABLE).where("_verdict = 'refused'")
    return rows.selectExpr("kafka_partition", "kafka_offset", "raw_value", "array_join(violations, ',') as violations")


def late_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The judged table after two drains; the second brings records of all times, most behind the watermark by then."""
    layout = Layout(scratch_folder(spark, "events"))
    whole = testbed.sensor_records(spark, sf_dir)
    for arrived in ("offset % 10 < 8", "offset % 10 >= 8"):
        write_layer(whole.where(arrived), layout, "topic", "records", mode="append")
        records = spark.readStream.schema(RECORD_SCHEMA).parquet(layout.path("topic", "records"))
        pipeline.start_bronze_stream(records, layout, drain=True).awaitTermination()
        schema = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE).schema
        pipeline.start_judged_stream(
            spark, layout, schema, drain=True, state_partitions=STATE_PARTITIONS, keep_late=True
        ).awaitTermination()
    return read_layer(spark, layout, pipeline.JUDGED_EVENTS, pipeline.EVENT_TABLE)


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event that came behind the watermark, and whether it was lost or a copy of an accepted one."""
    fates = pipeline.late_fates(late_drain(spark, sf_dir))
    return fates.select("kafka_partition", "kafka_offset", "event_id", "event_timestamp", "sensor_type", "value", "fate")


def late_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lost events by key, with the number of their records and when these arrived."""
    return pipeline.late_keys(late_drain(spark, sf_dir))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was stored of the batches of a drain, a file a batch."""
    layout, listener = Layout(scratch_folder(spark, "events")), BatchProgress()
    write_layer(testbed.sensor_records(spark, sf_dir).repartition(BATCHES), layout, "topic", "records")
    reader = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1)
    query = pipeline.start_bronze_stream(reader.parquet(layout.path("topic", "records")), layout, True, listener)
    pipeline.follow_stream(spark, layout, pipeline.BRONZE_EVENTS, query, listener)
    status = pipeline.stream_status(spark, layout, pipeline.BRONZE_EVENTS)
    return status.select("batches", "missing_batches", "input_rows", "late_rows")


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events of the stored streaming Bronze table, each with the table's row count."""
    layout = Layout(scratch_folder(spark, "events"))
    write_layer(testbed.sensor_records(spark, sf_dir), layout, "topic", "records")
    records = spark.readStream.schema(RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(records, layout, drain=True).awaitTermination()
    rows, newest = pipeline.stream_report(spark, layout)
    return newest.selectExpr("*", f"{rows}L as total_rows")


def newest_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events of a streaming Bronze table by day of arrival, read from its newest days."""
    layout = Layout(scratch_folder(spark, "events"))
    write_layer(testbed.sensor_records(spark, sf_dir), layout, "topic", "records")
    records = spark.readStream.schema(RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(records, layout, drain=True, by_day=True).awaitTermination()
    return pipeline.newest_stored(spark, layout)


def stream_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls of the event stream by the counts its batches carried, without a look at the stored events."""
    layout, listener = Layout(scratch_folder(spark, "events")), BatchProgress()
    write_layer(testbed.sensor_records(spark, sf_dir).repartition(BATCHES), layout, "topic", "records")
    reader = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1)
    query = pipeline.start_bronze_stream(reader.parquet(layout.path("topic", "records")), layout, True, listener)
    pipeline.follow_stream(spark, layout, pipeline.BRONZE_EVENTS, query, listener)
    return events.stream_completeness(read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.PROGRESS))


def _per_table(report: Callable[[DataFrame, str, str, str, tuple[str, ...]], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reports = []
        for t, contract in OPERATIONAL_TABLES.items():
            raw = bronze(spark, sf_dir, t)
            verdict = f"{contract.accepted()} as _verdict"
            judged = standardised(raw, contract).selectExpr("*", verdict)
            reports.append(report(judged, t, contract.key, "_verdict", testbed.TIE_BREAKS.get(t, ())))
        return quality.stack_reports(reports)

    return run


def dq_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = []
    for t, contract in OPERATIONAL_TABLES.items():
        unique = dedupe(bronze(spark, sf_dir, t), contract.key, testbed.TIE_BREAKS.get(t, ()))
        reports.append(quality.rejections(standardised(unique, contract), t, contract.rules()))
    return quality.stack_reports(reports)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, reports = SilverTables(spark, sf_dir), []
    for child, contract in OPERATIONAL_TABLES.items():
        for ref in contract.references:
            parent_key = OPERATIONAL_TABLES[ref.table].key
            found = orphans(tables[child], tables[ref.table], ref.column, parent_key)
            labels = [f"'{child}' as child", f"'{ref.column}' as column", f"'{ref.table}' as parent"]
            reports.append(found.selectExpr("coalesce(sum(n), 0L) as n").selectExpr(*labels, "n"))
    return quality.stack_reports(reports)


def dq_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = gold_keyed(spark, sf_dir)
    keys = {**marts.DIMENSION_KEYS, **marts.FACT_KEYS}
    return quality.stack_reports([quality.key_uniqueness(frames[t], t, key) for t, key in keys.items()])


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stack_reports([quality.null_counts(bronze(spark, sf_dir, t), t) for t in OPERATIONAL_TABLES])


def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = gold_keyed(spark, sf_dir)
    frames |= marts.build_kpis(frames["dim_machines"], frames)
    return quality.with_total(quality.stack_reports([quality.row_count(frames[t], t) for t in marts.GOLD_TABLES]))


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.latest_events(bronze_events(testbed.sensor_records(spark, sf_dir)))


def known_and_seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The sensors there are, and one row for each sensor that raised an alert."""
    known = silver(spark, sf_dir, "sensors").select("sensor_id", "sensor_code", "machine_id", "status")
    seen = bronze(spark, sf_dir, "alerts").selectExpr(
        "sensor_id",
        "'UNREGISTERED-' || cast(sensor_id as string) as sensor_code",
        "machine_id",
        "'INACTIVE' as status",
    )
    return known, seen


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the sensors that raised alerts without being known."""
    return append_new(*known_and_seen(spark, sf_dir), "sensor_id")


def stored_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table, twice: the second time nothing is new."""
    layout = Layout(scratch_folder(spark, "insert"))
    known, seen = known_and_seen(spark, sf_dir)
    write_layer(known, layout, "silver", "sensors")
    for _ in range(2):
        layers.insert_if_absent(seen, layout, "silver", "sensors", "sensor_id")
    return read_layer(spark, layout, "silver", "sensors")


def layer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table through a counted write and back."""
    layout = Layout(scratch_folder(spark, "layer"))
    write_checked(fact_production(spark, sf_dir), layout, "gold", "fact_production")
    return read_layer(spark, layout, "gold", "fact_production")


def batch_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch chain through stored layers; a row for every table it stored.

    ``measure`` is the sum of a whole-number column, ``unstamped`` the rows without the layer's time stamp.
    """
    layout = Layout(scratch_folder(spark, "batch"))
    pipeline.run_batch(spark, layout, testbed.GivenTables(sf_dir), tie_breaks=testbed.TIE_BREAKS)
    stamps = {"bronze": "_ingestion_timestamp", "silver": "_silver_processed_at", "gold": "_gold_processed_at"}
    tables = [(layer, t) for layer in ("bronze", "silver") for t in OPERATIONAL_TABLES]
    tables += [("gold", t) for t in marts.GOLD_TABLES]
    keys = {t: c.key for t, c in OPERATIONAL_TABLES.items()} | marts.DIMENSION_KEYS | marts.FACT_KEYS
    measures = keys | {
        "kpi_daily_production": "production_records",
        "kpi_workshop_performance": "workshop_id",
        "kpi_machine_performance": "alert_count",
        "kpi_maintenance_summary": "intervention_count",
    }
    reports = [
        read_layer(spark, layout, layer, t)
        .selectExpr(
            "count(1) as rows",
            f"bigint(coalesce(sum({measures[t]}), 0)) as measure",
            f"count_if({stamps[layer]} is null) as unstamped",
        )
        .selectExpr(f"'{layer}' as layer", f"'{t}' as table", "*")
        for layer, t in tables
    ]
    return quality.stack_reports(reports)


def loaded(spark: SparkSession, sf_dir: str, layout: Layout, tables: list[str]) -> None:
    """Two loads of operational tables: wrong first versions, their corrections, late rows, rows sent again."""
    machines = pipeline.stamp(dim_machines(spark, sf_dir), "_gold_processed_at")
    publish_checked(spark, {"dim_machines": machines}, layout, pipeline.GOLD, {"dim_machines": "machine_id"})
    loads = {t: testbed.loads(bronze(spark, sf_dir, t), t, OPERATIONAL_TABLES[t].key) for t in tables}
    for k in range(testbed.LOADS):
        changes = {t: parts[k] for t, parts in loads.items()}
        increments.run_increment(spark, layout, changes, f"load-{k}", tie_breaks=testbed.TIE_BREAKS, months=12)


def _incremental(table: str, tables: list[str], layer: str = pipeline.GOLD) -> Query:
    """A table after increments; it equals the one a full run gives."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout = Layout(scratch_folder(spark, "increments"))
        loaded(spark, sf_dir, layout, tables)
        return read_layer(spark, layout, layer, table).drop(increments.MONTH)

    return run


def staged_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of a fact table after a good run, a run refused for repeated keys, and another good one."""
    layout, keys = Layout(scratch_folder(spark, "staged")), {"fact_production": "production_id"}
    whole = fact_production(spark, sf_dir)
    early = whole.where("production_date < '1998-01-01'")
    reports = []
    for step, rows in enumerate([early, whole.unionAll(early), whole], 1):
        try:
            publish_checked(spark, {"fact_production": rows}, layout, pipeline.GOLD, keys)
            refused = False
        except quality.QualityError:
            refused = True
        seen = read_layer(spark, layout, pipeline.GOLD, "fact_production")
        seen = seen.selectExpr("count(1) as rows", "bigint(coalesce(sum(production_id), 0)) as keys")
        report = f"{layout.root}/report/{step}"
        seen.selectExpr(f"{step} as step", f"{str(refused).lower()} as refused", "*").write.parquet(report)
        reports.append(spark.read.parquet(report))
    return quality.stack_reports(reports)


BUCKETS = 8


def colocated(spark: SparkSession, sf_dir: str, layout: Layout, key: str | None = None, buckets: int = BUCKETS) -> None:
    """Dimensions and facts in buckets: those with ``key`` by it, or every table by its own key."""
    keys = {**marts.DIMENSION_KEYS, **marts.FACT_KEYS}
    for table, df in gold_keyed(spark, sf_dir).items():
        if key is None or key in df.columns:
            write_bucketed(df, layout, pipeline.GOLD, table, key or keys[table], buckets)


def colocated_machine_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table from tables in buckets of machines: nothing is shuffled."""
    layout = Layout(scratch_folder(spark, "buckets"))
    colocated(spark, sf_dir, layout, "machine_id")
    facts = (read_bucketed(spark, layout, pipeline.GOLD, t) for t in marts.FACT_KEYS)
    return marts.kpi_machine_performance(*facts, read_bucketed(spark, layout, pipeline.GOLD, "dim_machines"))


def colocated_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key checks on tables in buckets of their own keys: only totals leave a task."""
    layout = Layout(scratch_folder(spark, "buckets"))
    colocated(spark, sf_dir, layout)
    keys = {**marts.DIMENSION_KEYS, **marts.FACT_KEYS}
    return quality.stack_reports(
        [quality.key_uniqueness(read_bucketed(spark, layout, pipeline.GOLD, t), t, key) for t, key in keys.items()]
    )


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(query(prepare(spark), sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Daily production at sf 0.001."""
    return queries()["kpi_daily_production"](spark, ENTRY_DIR)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_production": bronze_production,
        "bronze_sensor_events": lambda spark, sf_dir: bronze_events(testbed.sensor_records(spark, sf_dir)),
    }
    found |= {f"silver_{t}": partial(silver, table=t) for t in OPERATIONAL_TABLES}
    found |= {"silver_sensor_events": silver_sensor_events}
    found |= {
        "dim_workshops": _from_silver(marts.dim_workshops, "workshops"),
        "dim_machines": dim_machines,
        "dim_technicians": _from_silver(marts.dim_technicians, "technicians"),
        "dim_sensors": dim_sensors,
        "fact_production": fact_production,
        "fact_maintenance": fact_maintenance,
        "fact_alerts": fact_alerts,
        "kpi_daily_production": kpi_daily_production,
        "kpi_workshop_performance": kpi_workshop_performance,
        "kpi_machine_performance": kpi_machine_performance,
        "kpi_maintenance_summary": kpi_maintenance_summary,
        "dq_row_counts": lambda spark, sf_dir: quality.with_total(_per_table(quality.row_accounting)(spark, sf_dir)),
        "dq_rejections": dq_rejections,
        "dq_duplicates": _per_table(quality.duplicate_report),
        "dq_orphans": dq_orphans,
        "dq_key_uniqueness": dq_key_uniqueness,
        "dq_completeness": dq_completeness,
        "gold_row_counts": gold_row_counts,
        "latest_events": latest_events,
        "insert_if_absent": insert_if_absent,
        "stored_insert_if_absent": stored_insert_if_absent,
        "stream_quality": stream_quality,
        "stream_report": stream_report,
        "stream_progress": stream_progress,
        "stream_completeness": stream_completeness,
        "newest_by_day": newest_by_day,
        "stream_accounts": stream_accounts,
        "refused_events": refused_events,
        "late_events": late_events,
        "late_keys": late_keys,
        "layer_round_trip": layer_round_trip,
        "batch_pipeline": batch_pipeline,
        "staged_publication": staged_publication,
        "colocated_machine_performance": colocated_machine_performance,
        "colocated_key_uniqueness": colocated_key_uniqueness,
        "incremental_daily_production": _incremental("kpi_daily_production", ["production"]),
        "incremental_workshop_performance": _incremental("kpi_workshop_performance", ["production"]),
        "incremental_maintenance_summary": _incremental("kpi_maintenance_summary", ["maintenance"]),
        "incremental_machine_performance": _incremental("kpi_machine_performance", list(increments.FACTS_OF)),
        "incremental_fact_production": _incremental("fact_production", ["production"], increments.FACTS),
    }
    return {name: _registered(query) for name, query in found.items()} | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | _text_queries()[1]


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text operators and their pipeline, if that subpackage is installed."""
    try:
        import corpus_pipeline
        from millrace.llm import queries as text
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "millrace.llm", "millrace.llm.queries"):
            raise
        return {}, {}
    return text.QUERIES | {"pipeline": corpus_pipeline.run}, text.ORACLE_SQL | corpus_pipeline.oracles()

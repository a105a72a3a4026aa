"""The jobs, as plain functions: batch Bronze, Silver, Gold, validation, publication, and the two streams."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.expressions import literal, name
from millrace.operators.dedupe import dedupe
from millrace.operators.enrich import orphans
from millrace.operators.quality import (
    QualityError,
    latest,
    require_rows,
    require_unique,
    stack_reports,
)
from millrace.plans import marts
from millrace.plans.contract import TableContract, standardised, with_derived
from millrace.plans.tables import OPERATIONAL_TABLES, SENSOR_EVENTS
from millrace.sources.jdbc import JdbcConnection, JdbcSource, publish
from millrace.session import prepare, together
from millrace.sources.layers import (
    Layout,
    overwrite_partitions,
    read_layer,
    read_layer_stream,
    require_stored,
    stored_counts,
    write_counted,
    write_layer,
)
from millrace.sources.staging import Folders, require_volume, staged, staging
from millrace.streaming.events import (
    EVENT_KEY,
    ARRIVAL_DAY,
    PROGRESS_SCHEMA,
    BatchProgress,
    bronze_events,
    by_arrival_day,
    clean_events,
    follow,
    judged_events,
    observed,
    start_append,
    start_batches,
    stream_totals,
)

T = TypeVar("T")
log = logging.getLogger(__name__)

BRONZE, SILVER, GOLD, QUARANTINE = "bronze", "silver", "gold", "quarantine"
JUDGED = "judged"
SUMS = "sums"
BRONZE_EVENTS = "bronze_streaming"
SILVER_EVENTS = "silver_streaming"
JUDGED_EVENTS = "judged_streaming"
EVENT_TABLE = "sensor_readings"
PROGRESS = "stream_progress"
LATEST_EVENT_COLUMNS = (
    "event_id",
    "sensor_id",
    "machine_id",
    "sensor_type",
    "value",
    "unit",
    "event_timestamp",
    "kafka_partition",
    "kafka_offset",
)


def run_id(now: datetime) -> str:
    return now.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def stamp(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def stamp_bronze(df: DataFrame, system: str, table: str, ingestion_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_system": F.lit(system),
            "_source_table": F.lit(table),
            "_ingestion_id": F.lit(ingestion_id),
        }
    )


def operational_store(conn: JdbcConnection, connections: int) -> JdbcSource:
    """The store as a Bronze source; the tables that grow without end are scanned in ``connections`` key ranges."""
    keys = {t: OPERATIONAL_TABLES[t].key for t in ("production", "maintenance", "alerts")}
    return JdbcSource(conn, connections, keys)


def _logged(layer: str, table: str, job: Callable[[], T]) -> T:
    """Run a table's job and log what it did and how long it took."""
    begun = time.perf_counter()
    found = job()
    log.info("%s.%s: %s in %.1f s", layer, table, found, time.perf_counter() - begun)
    return found


def run_bronze(
    spark: SparkSession, layout: Layout, source, now: datetime | None = None, least_share: float = 0.0
) -> dict[str, int]:
    """Copy every operational table as it is. ``source`` has ``system`` and ``read(spark, table)``.

    The copies replace the tables of the last run together, once all of them are whole and none has fewer rows than
    ``least_share`` of what it replaces.
    """
    ingestion_id = run_id(now or datetime.now(timezone.utc))

    def copy(stage: Layout, table: str) -> int:
        raw = stamp_bronze(source.read(spark, table), source.system, table, ingestion_id)
        return write_counted(raw, stage, BRONZE, table)

    with staged(spark, layout) as stage:
        jobs = {t: partial(_logged, BRONZE, t, partial(copy, stage, t)) for t in OPERATIONAL_TABLES}
        counts = together(spark, jobs)
        require_stored(spark, stage, BRONZE, counts)
        if least_share:
            require_volume(spark, stage, layout, BRONZE, counts, least_share)
    return counts


@dataclass(frozen=True)
class SilverCounts:
    """bronze = silver + duplicates + invalid."""

    bronze: int
    duplicates: int
    invalid: int
    silver: int
    by_rule: Mapping[str, int]

    @property
    def rejected(self) -> int:
        return self.bronze - self.silver


def silver_table(
    spark: SparkSession,
    layout: Layout,
    stage: Layout,
    contract: TableContract,
    tie_break: Sequence[str] = (),
    keep_rejected: bool = False,
) -> dict[str, int]:
    """Dedup, check and write one table in a single job, from Bronze of ``layout`` to ``stage``.

    The distinct-key count and the failures per rule are observed between dedup and filter, in the same
    stage that writes, so no count re-runs the shuffle. With ``keep_rejected`` all judged rows are stored once and
    Silver and quarantine are both filtered from there, so the dedup is not repeated either.
    """
    bronze = read_layer(spark, layout, BRONZE, contract.name)
    tidy = standardised(dedupe(bronze, contract.key, tie_break), contract)
    seen = Observation()
    failures = (F.expr(f"count_if(not {rule})").alias(label) for label, rule in contract.rules().items())
    watched = tidy.observe(seen, F.expr("count(1) as keys"), *failures)
    if keep_rejected:
        judged = watched.selectExpr("*", f"{contract.violations()} as violations")
        write_layer(judged, stage, JUDGED, contract.name)
        judged = read_layer(spark, stage, JUDGED, contract.name)
        kept = write_counted(judged.where("size(violations) > 0"), stage, QUARANTINE, contract.name)
        accepted = judged.where("size(violations) = 0").drop("violations")
    else:
        kept, accepted = 0, watched.where(contract.accepted())
    rows = stamp(with_derived(accepted, contract), "_silver_processed_at")
    written = write_counted(rows, stage, SILVER, contract.name)
    return {**seen.get, "rows": written, "quarantined": kept}


def run_silver(
    spark: SparkSession,
    layout: Layout,
    tie_breaks: Mapping[str, Sequence[str]] | None = None,
    keep_rejected: bool = False,
    orphan_limit: float | None = None,
) -> dict[str, SilverCounts]:
    """Clean every Bronze table; ``keep_rejected`` also writes the invalid rows with the rules they broke.

    The tables replace those of the last run together, after all were read back whole. ``orphan_limit`` is the share
    of a table's rows that may point to rows that are not there; without it orphans are let through.
    """

    def job(stage: Layout, table: str, contract: TableContract) -> dict[str, int]:
        order = tuple((tie_breaks or {}).get(table, ()))
        return _logged(SILVER, table, partial(silver_table, spark, layout, stage, contract, order, keep_rejected))

    with staged(spark, layout) as stage:
        found = together(spark, {t: partial(job, stage, t, c) for t, c in OPERATIONAL_TABLES.items()})
        require_stored(spark, stage, SILVER, {t: seen["rows"] for t, seen in found.items()})
        if keep_rejected:
            require_stored(spark, stage, QUARANTINE, {t: seen["quarantined"] for t, seen in found.items()})
        if orphan_limit is not None:
            require_references({t: read_layer(spark, stage, SILVER, t) for t in found}, orphan_limit)
    bronze = stored_counts(spark, layout, BRONZE, OPERATIONAL_TABLES)
    return {
        t: SilverCounts(
            bronze=bronze[t],
            duplicates=bronze[t] - seen["keys"],
            invalid=seen["keys"] - seen["rows"],
            silver=seen["rows"],
            by_rule={rule: seen[rule] for rule in OPERATIONAL_TABLES[t].rules()},
        )
        for t, seen in found.items()
    }


def total(counts: Mapping[str, SilverCounts]) -> SilverCounts:
    """The sum over all tables; failures by rule stay with their tables."""
    fields = ("bronze", "duplicates", "invalid", "silver")
    return SilverCounts(**{f: sum(getattr(c, f) for c in counts.values()) for f in fields}, by_rule={})


def run_gold(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Build, write and check the serving model.

    Dimensions and facts are written first; their keys are checked on the stored tables and the KPI tables read
    those back, so no lineage is computed twice. What two KPI tables need of the production fact is summed up once and
    kept until they are written. All of it happens in staging: a model that fails a check never takes the place of the
    last good one.
    """
    silver = {t: read_layer(spark, layout, SILVER, t) for t in OPERATIONAL_TABLES}
    with staged(spark, layout) as stage:
        counts = _write_gold(spark, {**marts.build_dimensions(silver), **marts.build_facts(silver)}, stage)
        keys = {**marts.DIMENSION_KEYS, **marts.FACT_KEYS}
        stored = {t: read_layer(spark, stage, GOLD, t) for t in keys}
        aside = staging(layout)
        sums = marts.machine_sums(stored["fact_production"])
        together(
            spark,
            {
                "keys": partial(require_unique, stored, keys),
                "sums": partial(write_layer, sums, aside, SUMS, "fact_production"),
            },
        )
        sums = read_layer(spark, aside, SUMS, "fact_production")
        counts |= _write_gold(spark, marts.build_kpis(stored["dim_machines"], stored, sums), stage)
        require_stored(spark, stage, GOLD, counts)
        Folders(spark, layout.root).remove(aside.root)
    return counts


def require_references(tables: Mapping[str, DataFrame], limit: float) -> None:
    """At most this share of a table's rows may carry a key that its parent table does not have."""
    reports = []
    for child, contract in OPERATIONAL_TABLES.items():
        rows = tables[child].selectExpr("count(1) as rows")
        for ref in contract.references:
            lost = orphans(tables[child], tables[ref.table], ref.column, OPERATIONAL_TABLES[ref.table].key)
            label = literal(f"{child}.{ref.column}")
            # Two frames of one row each.
            both = lost.selectExpr("coalesce(sum(n), 0L) as lost", "1 as one").join(rows.withColumn("one", F.lit(1)), "one")
            reports.append(both.selectExpr(f"{label} as reference", "lost", "rows"))
    broken = [r for r in stack_reports(reports).toLocalIterator() if r["lost"] > limit * r["rows"]]
    if broken:
        found = "; ".join(f"{r['reference']}: {r['lost']} of {r['rows']} rows" for r in broken)
        raise QualityError(f"too many rows without a parent: {found}")


def run_validate(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Every Gold table must be there and hold rows; returns their counts."""
    counts = stored_counts(spark, layout, GOLD, marts.GOLD_TABLES)
    empty = [t for t, n in counts.items() if not n]
    if empty:
        raise QualityError(f"no rows in {', '.join(empty)}")
    return counts


def run_publish(spark: SparkSession, layout: Layout, target) -> dict[str, int]:
    """Publish the Gold tables. ``target`` has ``write(df, table)`` and ``count(spark, table)``."""
    return {t: publish(read_layer(spark, layout, GOLD, t), target, t) for t in marts.GOLD_TABLES}


@dataclass(frozen=True)
class BatchResult:
    bronze: Mapping[str, int]
    silver: Mapping[str, SilverCounts]
    gold: Mapping[str, int]
    validated: Mapping[str, int]
    published: Mapping[str, int]


def run_batch(
    spark: SparkSession,
    layout: Layout,
    source,
    target=None,
    tie_breaks: Mapping[str, Sequence[str]] | None = None,
    keep_rejected: bool = False,
) -> BatchResult:
    """Bronze, Silver, Gold, validation, publication; the first failure stops the chain."""
    return BatchResult(
        bronze=run_bronze(spark, layout, source),
        silver=run_silver(spark, layout, tie_breaks, keep_rejected),
        gold=run_gold(spark, layout),
        validated=run_validate(spark, layout),
        published=run_publish(spark, layout, target) if target else {},
    )


def start_bronze_stream(
    records: DataFrame,
    layout: Layout,
    drain: bool = False,
    listener: BatchProgress | None = None,
    by_day: bool = False,
) -> StreamingQuery:
    """Sensor records (Kafka or record-shaped) into the streaming Bronze table.

    ``by_day`` partitions the table by day of arrival, so that its newest events are found without its history. It
    holds for the whole life of a table.
    """
    if listener:
        listener.listen(records.sparkSession)
    path = layout.path(BRONZE_EVENTS, EVENT_TABLE)
    checkpoint = layout.checkpoint(BRONZE_EVENTS, EVENT_TABLE)
    rows = observed(bronze_events(records))
    if not by_day:
        return start_append(rows, path, checkpoint, layout.fmt, drain=drain)
    return start_append(by_arrival_day(rows), path, checkpoint, layout.fmt, drain=drain, partitions=[ARRIVAL_DAY])


def start_silver_stream(
    spark: SparkSession,
    layout: Layout,
    schema=None,
    drain: bool = False,
    max_files: int | None = None,
    state_partitions: int | None = None,
    listener: BatchProgress | None = None,
) -> StreamingQuery:
    """Streaming Bronze into streaming Silver. File formats need the Bronze ``schema``.

    ``state_partitions`` is fixed by a stream's first start. It is a setting of a session made for this query, so
    other queries and streams do not see it. Unset, the given session's shuffle partitions count.
    """
    own = prepare(spark.newSession())
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    bronze = read_layer_stream(own, layout, BRONZE_EVENTS, EVENT_TABLE, schema, max_files)
    path = layout.path(SILVER_EVENTS, EVENT_TABLE)
    checkpoint = layout.checkpoint(SILVER_EVENTS, EVENT_TABLE)
    if listener:
        listener.listen(own)
    return start_append(clean_events(bronze), path, checkpoint, layout.fmt, drain=drain)


def start_judged_stream(
    spark: SparkSession,
    layout: Layout,
    schema=None,
    drain: bool = False,
    max_files: int | None = None,
    state_partitions: int | None = None,
    listener: BatchProgress | None = None,
    keep_late: bool = False,
) -> StreamingQuery:
    """Streaming Bronze into one table of accepted and refused events, written together by one query.

    The table is partitioned by verdict, query and batch. A batch that is repeated after a failure overwrites its own
    partitions, so nothing is stored twice, also by formats that know nothing of streams; a stream started anew, with
    another checkpoint, has another query id and overwrites nothing of the old one's. With ``keep_late`` the events that
    come behind the watermark are stored too, see :func:`late_fates`; it holds for the whole life of a stream.
    """
    own = prepare(spark.newSession())
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    bronze = read_layer_stream(own, layout, BRONZE_EVENTS, EVENT_TABLE, schema, max_files)
    if listener:
        listener.listen(own)
    store = partial(store_judged, layout)
    judged = judged_events(bronze, keep_late=keep_late)
    return start_batches(judged, store, layout.checkpoint(JUDGED_EVENTS, EVENT_TABLE), drain=drain)


def store_judged(layout: Layout, rows: DataFrame, query: str, batch: int) -> None:
    placed = rows.withColumns({"_query": F.lit(f"q-{query}"), "_batch": F.lit(batch)})
    overwrite_partitions(placed, layout, JUDGED_EVENTS, EVENT_TABLE, ["_verdict", "_query", "_batch"])


def stream_accounts(bronze: DataFrame, judged: DataFrame, late: int) -> DataFrame:
    """Every Bronze event has one fate: accepted, refused, late, or dropped as a copy; rows = the sum of these.

    ``judged`` is the stored table of both verdicts, ``late`` the late rows in the stream's stored progress.
    """
    valid = standardised(bronze, SENSOR_EVENTS).selectExpr(
        "count(1) as rows", f"count_if({SENSOR_EVENTS.accepted()}) as valid"
    )
    fates = judged.selectExpr("count_if(_verdict = 'accepted') as accepted", "count_if(_verdict = 'refused') as refused")
    # Two frames of one row each.
    both = valid.withColumn("one", F.lit(1)).join(fates.withColumn("one", F.lit(1)), "one")
    return both.selectExpr("rows", "accepted", "refused", f"{late}L as late", f"valid - accepted - {late}L as copies")


def late_fates(judged: DataFrame) -> DataFrame:
    """The late events of a judged table with their ``fate``: ``lost``, or ``copy`` of an event that was accepted.

    A late row that was accepted itself (it came in the batch that moved the watermark past it) is none of both and left
    out. With the accepted, the refused and the lost rows, whatever else came is a copy: no progress is needed. A
    record that Bronze holds twice has one answer.
    """
    late = judged.where("_verdict = 'late'").drop("_verdict", "_query", "_batch", "violations")
    record = ["kafka_topic", "kafka_partition", "kafka_offset"]
    at = ", ".join(record)
    accepted = judged.where("_verdict = 'accepted'").select(*EVENT_KEY, F.expr(f"struct({at}) as _accepted"))
    # Few keys are late: the semi join can send these to the accepted rows, the outer join that follows can not.
    accepted = accepted.join(late.select(*EVENT_KEY).distinct(), list(EVENT_KEY), "left_semi")
    met = late.join(accepted, list(EVENT_KEY), "left")
    # A replaced stream may have accepted an event once more: one answer a record.
    fates = met.groupBy(*(F.col(c) for c in late.columns)).agg(
        F.expr(f"coalesce(bool_or(_accepted <=> struct({at})), false) as _itself"),
        F.expr("if(count(_accepted) = 0, 'lost', 'copy') as fate"),
    )
    return fates.where("not _itself").drop("_itself")


def late_keys(judged: DataFrame) -> DataFrame:
    """How many records of each lost event came, and the first and last of their arrivals."""
    lost = late_fates(judged).where("fate = 'lost'")
    return lost.groupBy(*EVENT_KEY).agg(
        F.expr("count(1) as records"),
        F.expr("min(kafka_timestamp) as first_arrival"),
        F.expr("max(kafka_timestamp) as last_arrival"),
    )


def follow_stream(
    spark: SparkSession, layout: Layout, layer: str, query: StreamingQuery, listener: BatchProgress
) -> None:
    """Wait for a stream and keep the progress of all its batches in a table of the layer.

    ``listener`` is the one the stream was started with.
    """

    def store(rows: list[tuple]) -> None:
        # One small file for many batches; never more rows than batches since the last flush.
        write_layer(spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1), layout, layer, PROGRESS, mode="append")

    follow(query, listener, store)


def stream_status(spark: SparkSession, layout: Layout, layer: str) -> DataFrame:
    """Batches, rows in, late rows and watermark over a stream's whole life."""
    return stream_totals(read_layer(spark, layout, layer, PROGRESS))


def stream_quality(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """How a drained event stream came through: rows, rows refused by each rule, copies, accepted.

    ``bronze`` and ``silver`` are the stored tables; a row may break several rules. Every accepted row that is
    not in Silver was a copy or late.
    """
    rules = SENSOR_EVENTS.rules()
    tidy = standardised(bronze, SENSOR_EVENTS)
    parts = ["count(1) as rows", f"count_if({SENSOR_EVENTS.accepted()}) as valid"]
    parts += [f"count_if(not {rule}) as {name(label)}" for label, rule in rules.items()]
    pairs = ["'rows', rows", "'copies', valid", *(f"{literal(f'refused {label}')}, {name(label)}" for label in rules)]
    came = tidy.selectExpr(*parts).selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) as (what, n)")
    kept = silver.selectExpr("count(1) as n").selectExpr("stack(2, 'accepted', n, 'copies', -n) as (what, n)")
    return came.unionAll(kept).groupBy("what").agg(F.expr("sum(n) as n"))


def latest_events(bronze: DataFrame, n: int = 10) -> DataFrame:
    ties = ("kafka_topic", "kafka_partition", "kafka_offset")
    return latest(bronze, "kafka_timestamp", n, LATEST_EVENT_COLUMNS, ties)


def newest_stored(spark: SparkSession, layout: Layout, n: int = 10) -> DataFrame:
    """``latest_events`` of a Bronze table by day of arrival, from as few of the newest days as hold ``n`` events.

    Days are read off the table's folder, newest first, and taken twice as many at a time until they hold enough;
    any event of an earlier day is older than these. Events without a time of arrival are the oldest: they, and so
    the whole table, are looked at only when all days together hold fewer than ``n``.
    """
    bronze = read_layer(spark, layout, BRONZE_EVENTS, EVENT_TABLE)
    folders = Folders(spark, layout.root).names(layout.path(BRONZE_EVENTS, EVENT_TABLE))
    days = [day for key, _, day in (f.partition("=") for f in folders) if key == ARRIVAL_DAY and day[:1].isdigit()]
    days.sort(reverse=True)
    taken = 1
    while days:
        recent = bronze.where(F.col(ARRIVAL_DAY) >= F.to_date(F.lit(days[min(taken, len(days)) - 1])))
        if len(recent.select(F.lit(1)).take(n)) == n:
            return latest_events(recent, n)
        if taken >= len(days):
            break
        taken *= 2
    return latest_events(bronze, n)


def stream_report(spark: SparkSession, layout: Layout) -> tuple[int, DataFrame]:
    """Row count and newest events of the streaming Bronze table, which must not be empty."""
    bronze = read_layer(spark, layout, BRONZE_EVENTS, EVENT_TABLE)
    require_rows(bronze, EVENT_TABLE)
    newest = newest_stored(spark, layout) if ARRIVAL_DAY in bronze.columns else latest_events(bronze)
    return bronze.count(), newest


def _write_gold(spark: SparkSession, frames: Mapping[str, DataFrame], layout: Layout) -> dict[str, int]:
    def write(table: str) -> int:
        return write_counted(stamp(frames[table], "_gold_processed_at"), layout, GOLD, table)

    return together(spark, {t: partial(_logged, GOLD, t, partial(write, t)) for t in frames})

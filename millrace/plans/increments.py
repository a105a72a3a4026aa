"""Gold by increments: a load changes the days it touches and leaves the rest of history alone.

Each load has an id. Its raw rows are kept under that id, cleaned, and turned into fact rows. Facts are stored by month;
a row whose key is already stored replaces it, wherever that was. From the facts of touched days, mergeable partials
(sum, count, least, largest a day and machine) are recomputed and stored by month as well; the KPI tables come from the
partials alone, which are small.

A load may be repeated under its id, after a failure or not, with the same result: what it touches is stored before
anything changes, and partitions are replaced from checked, staged tables. Loads of a fact come one at a time.

What a load costs: its own rows, the keys (one column) of the stored facts, the months it touches, and the partials.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregate import partial_sums, source_types
from millrace.operators.quality import require_unique
from millrace.plans import marts
from millrace.plans.contract import clean
from millrace.plans.pipeline import GOLD, stamp, stamp_bronze
from millrace.plans.tables import OPERATIONAL_TABLES
from millrace.sources.layers import Layout, read_layer, require_stored, write_layer, write_partitions
from millrace.sources.staging import Folders, finish_pending, publish_checked, replace_partitions, staging

CHANGES, TOUCHED, FACTS, PARTIALS = "bronze_changes", "touched_days", "facts", "partials"
# Year and month of a fact's day as one number; 0 where there is no day.
MONTH = "fact_month"
# Rows a file at which tasks write their own files of every month instead of bringing a month's rows together first.
ROWS_A_FILE = 50_000
FACTS_OF = {
    "production": ("fact_production", marts.fact_production),
    "maintenance": ("fact_maintenance", marts.fact_maintenance),
    "alerts": ("fact_alerts", marts.fact_alerts),
}


def month_of(day: str, months: int = 1) -> str:
    """The first month of the ``months`` months, counted from January of year 0, that a day lies in."""
    first = f"(year({day}) * 12 + month({day}) - 1) div {months} * {months}"
    return f"coalesce(int({first} div 12 * 100 + {first} % 12 + 1), 0)"


def run_increment(
    spark: SparkSession,
    layout: Layout,
    changes: Mapping[str, DataFrame],
    load: str,
    system: str = "store",
    tie_breaks: Mapping[str, Sequence[str]] | None = None,
    months: int = 1,
) -> dict[str, int]:
    """Work changed raw rows of operational fact tables into facts, partials and KPI tables; rows of each fact changed.

    ``changes`` are new, late and corrected rows by table. Of copies within a load one wins as in a full run; a row of
    a later load replaces that of an earlier one. A correction that breaks a rule is refused and the stored row stays.
    Machines are those of the stored ``dim_machines``. ``months`` is how many a partition holds: more than one for
    facts so few that a month would be a tiny file.
    """
    finish_pending(spark, layout)
    counts = {}
    for table, raw in changes.items():
        fact, build = FACTS_OF[table]
        write_layer(stamp_bronze(raw, system, table, load), layout, CHANGES, f"{table}/{load}")
        rows = read_layer(spark, layout, CHANGES, f"{table}/{load}").drop(*_stamps())
        order = tuple((tie_breaks or {}).get(table, ()))
        counts[fact] = load_fact(spark, layout, fact, build(clean(rows, OPERATIONAL_TABLES[table], order)), load, months)
        refresh_partials(spark, layout, fact, load)
    refresh_kpis(spark, layout)
    return counts


def load_fact(
    spark: SparkSession, layout: Layout, fact: str, changes: DataFrame, load: str, months: int = 1
) -> int:
    """Put changed rows into the stored fact, rewriting the months they come from and go to; returns their number."""
    key, day, stage = marts.FACT_KEYS[fact], marts.FACT_PARTIALS[fact].day, staging(layout)
    placed = changes.selectExpr("*", f"{month_of(day, months)} as {MONTH}")
    count = written = write_partitions(placed, stage, FACTS, fact, [MONTH], gather=False)
    # Partitioned folders without a row have no schema.
    new = read_layer(spark, stage, FACTS, fact) if count else spark.createDataFrame([], placed.schema)
    known = Folders(spark, layout.root).exists(layout.path(FACTS, fact))
    days = new.select(F.col(day).alias("day"), MONTH)
    if known:
        stored = read_layer(spark, layout, FACTS, fact)
        before = stored.select(key, day, MONTH).join(new.select(key), key, "left_semi")
        days = days.unionAll(before.select(F.col(day).alias("day"), MONTH))
    # Appended, not replaced: a repeated load also knows where its rows were before its first try.
    write_layer(days.distinct(), layout, TOUCHED, f"{fact}/{load}", mode="append")
    touched = touched_months(spark, layout, fact, load)
    if not touched:
        return 0
    rows, total = [new], count
    if known:
        there = stored.where(F.col(MONTH).isin(touched))
        rows.append(there.join(new.select(key), key, "left_anti"))
        total += there.count()
    if not _large(spark, total, touched):
        stage = staging(layout)
        written = write_partitions(reduce(DataFrame.unionByName, rows), stage, FACTS, fact, [MONTH])
    elif known:
        written += write_partitions(rows[1], stage, FACTS, fact, [MONTH], mode="append", gather=False)
    require_stored(spark, stage, FACTS, {fact: written})
    require_unique({fact: read_layer(spark, stage, FACTS, fact)}, {fact: key})
    replace_partitions(spark, stage, layout, FACTS, fact, MONTH, touched)
    return count


def refresh_partials(spark: SparkSession, layout: Layout, fact: str, load: str) -> None:
    """Recompute the stored partials of the days a load has touched."""
    months, spec, stage = touched_months(spark, layout, fact, load), marts.FACT_PARTIALS[fact], staging(layout)
    if not months:
        return
    touched = read_layer(spark, layout, TOUCHED, f"{fact}/{load}").distinct()
    facts = read_layer(spark, layout, FACTS, fact).where(F.col(MONTH).isin(months))
    changed = facts.join(touched.drop(MONTH), _same_day(facts, touched, spec.day), "left_semi")
    rows = partial_sums(changed, [*spec.keys, MONTH], spec.measures)
    if Folders(spark, layout.root).exists(layout.path(PARTIALS, fact)):
        stored = read_layer(spark, layout, PARTIALS, fact).where(F.col(MONTH).isin(months))
        kept = stored.join(touched.drop(MONTH), _same_day(stored, touched, spec.day), "left_anti")
        rows = kept.unionByName(rows)
    gather = not _large(spark, facts.count(), months)
    written = write_partitions(rows, stage, PARTIALS, fact, [MONTH], gather=gather)
    require_stored(spark, stage, PARTIALS, {fact: written})
    replace_partitions(spark, stage, layout, PARTIALS, fact, MONTH, months)


def refresh_kpis(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Rebuild the KPI tables whose facts have partials, and publish them together."""
    folders = Folders(spark, layout.root)
    facts = [f for f in marts.FACT_PARTIALS if folders.exists(layout.path(PARTIALS, f))]
    partials = {f: read_layer(spark, layout, PARTIALS, f) for f in facts}
    sources = {f: source_types(read_layer(spark, layout, FACTS, f)) for f in facts}
    kpis = marts.kpis_from_partials(read_layer(spark, layout, GOLD, "dim_machines"), partials, sources)
    stamped = {t: stamp(df, "_gold_processed_at") for t, df in kpis.items()}
    return publish_checked(spark, stamped, layout, GOLD, {})


def touched_months(spark: SparkSession, layout: Layout, fact: str, load: str) -> list[int]:
    """The months a load comes from and goes to; a number a month comes to the driver."""
    days = read_layer(spark, layout, TOUCHED, f"{fact}/{load}")
    return sorted(r[0] for r in days.select(MONTH).distinct().toLocalIterator())


def _large(spark: SparkSession, rows: int, months: Sequence[int]) -> bool:
    """Whether files stay large when every task writes one of each month; a shuffle of all rows is spared then."""
    return rows >= ROWS_A_FILE * len(months) * spark.sparkContext.defaultParallelism


def _same_day(rows: DataFrame, touched: DataFrame, day: str) -> Column:
    return rows[day].eqNullSafe(touched["day"])


def _stamps() -> tuple[str, ...]:
    return ("_ingestion_timestamp", "_source_system", "_source_table", "_ingestion_id")

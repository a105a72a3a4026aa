"""Event parsing, stateful dedup, lateness and restarts, on file streams."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest

from millrace.plans import pipeline
from millrace.sources.layers import Layout, read_layer
from millrace.streaming import events as ev

T0 = datetime(2024, 5, 1, 12, 0, 0)


def records(spark, payloads, start=0):
    rows = [
        (b"1", p.encode() if p is not None else None, "t", 0, start + i, T0 + timedelta(seconds=start + i))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, ev.RECORD_SCHEMA)


def payload(event_id, seconds=0, **change):
    at = (T0 + timedelta(seconds=seconds)).isoformat()
    fields = dict(sensor_id=1, machine_id=2, sensor_type='"energy"', value=5.0, unit='" W "', event_timestamp=f'"{at}Z"')
    fields |= change
    body = ",".join(f'"{k}":{v}' for k, v in fields.items())
    return f'{{"event_id":"{event_id}",{body}}}'


def test_kafka_options():
    options = ev.kafka_options("h:9092", "sensor-readings", 1000)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert "maxOffsetsPerTrigger" not in ev.kafka_options("h", "t")


def test_bronze_keeps_everything_and_nulls_what_it_cannot_parse(spark):
    payloads = [
        payload("ok"),
        "not json",
        "",
        "{}",
        None,
        payload("bad", value='"high"'),
        payload("more", extra='{"a":1}'),
        '{"event_id":17}',
    ]
    out = ev.bronze_events(records(spark, payloads)).orderBy("kafka_offset").collect()
    assert [r.raw_value for r in out] == payloads
    assert [r.event_id for r in out] == ["ok", None, None, None, None, "bad", "more", "17"]
    assert [r.value for r in out] == [5.0, None, None, None, None, None, 5.0, None]
    assert out[5].sensor_id == 1 and out[0].event_timestamp == T0
    assert out[0].kafka_key == "1" and out[0]._ingestion_timestamp is not None


def put(spark, layout, payloads, start=0):
    records(spark, payloads, start).coalesce(1).write.mode("append").parquet(layout.path("topic", "records"))


def drain(spark, layout):
    source = spark.readStream.schema(ev.RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(source, layout, drain=True).awaitTermination()
    schema = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE).schema
    query = pipeline.start_silver_stream(spark, layout, schema, drain=True, state_partitions=2)
    query.awaitTermination()
    return query


def silver(spark, layout):
    return read_layer(spark, layout, pipeline.SILVER_EVENTS, pipeline.EVENT_TABLE)


def test_copies_collapse_but_other_times_stay(spark, layout):
    put(spark, layout, [payload("a"), payload("a"), payload("a", 1), payload("b"), "junk"])
    drain(spark, layout)
    rows = silver(spark, layout).collect()
    assert sorted((r.event_id, r.event_timestamp) for r in rows) == [
        ("a", T0), ("a", T0 + timedelta(seconds=1)), ("b", T0)
    ]
    assert {(r.sensor_type, r.unit, r._data_quality_status) for r in rows} == {("ENERGY", "W", "VALID")}


def test_late_rows_restart_and_status(spark, layout):
    put(spark, layout, [payload("a", 0), payload("new", 3600)])
    drain(spark, layout)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # The watermark now stands ten minutes before the newest event.
    edge = 3600 - 600
    put(spark, layout, [payload("on", edge), payload("under", edge - 1), payload("over", edge + 1), payload("new", 3600)], 10)
    query = drain(spark, layout)
    ids = sorted(r.event_id for r in silver(spark, layout).collect())
    assert ids == ["a", "new", "over"]
    status = ev.stream_status(query)
    assert not status["active"] and status["error"] is None
    seen = [ev.progress_row(p) for p in query.recentProgress]
    assert (sum(r[4] for r in seen), sum(r[5] for r in seen)) == (4, 2)
    drain(spark, layout)
    assert silver(spark, layout).count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    count, latest = pipeline.stream_report(spark, layout)
    assert count == 6 and [r.kafka_offset for r in latest.collect()] == [13, 12, 11, 10, 1, 0]


@pytest.mark.parametrize("salts", [1, 16])
def test_hot_event_collapses_with_and_without_salt(spark, layout, salts):
    storm = [payload("hot")] * 60 + [payload(f"e{i}", i % 7) for i in range(40)] * 2
    put(spark, layout, storm)
    source = spark.readStream.schema(ev.RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    query = ev.start_append(
        ev.clean_events(ev.bronze_events(source), salts),
        layout.path("silver", "t"),
        layout.checkpoint("silver", "t"),
        drain=True,
    )
    query.awaitTermination()
    assert sorted(r.event_id for r in read_layer(spark, layout, "silver", "t").collect()) == sorted(
        ["hot", *(f"e{i}" for i in range(40))]
    )


def test_cleaning_works_on_a_batch_frame_too(spark):
    out = ev.clean_events(ev.bronze_events(records(spark, [payload("a"), payload("a"), payload("b", value=9999)])))
    assert [r.event_id for r in out.collect()] == ["a"]


def test_totals_over_more_batches_than_a_query_remembers(spark, layout):
    """40 batches of one file each; rows in the first ones are late. Only the last 2 are in recentProgress."""
    # A batch's watermark holds from the batch after the next one on.
    files = [[payload("first", 7200)], [payload("second", 7250)]]
    files += [[payload("late1"), payload("late2")], [payload("late3"), payload("x", 7300)]]
    files += [[payload(f"e{k}", 7300 + k)] for k in range(36)]
    for k, values in enumerate(files):
        records(spark, values, 10 * k).coalesce(1).write.mode("append").parquet(layout.path("topic", "records"))
        if k < 4:
            time.sleep(1.1)  # files are taken in the order of their times
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "1")
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    listener = ev.BatchProgress()
    listener.listen(own)
    source = own.readStream.schema(ev.RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(layout.path("topic", "records"))
    clean = ev.clean_events(ev.bronze_events(source), salts=1)
    query = ev.start_append(clean, layout.path("silver", "t"), layout.checkpoint("silver", "t"), drain=True)
    pipeline.follow_stream(spark, layout, "silver", query, listener)
    (total,) = pipeline.stream_status(spark, layout, "silver").collect()
    assert len(query.recentProgress) <= 3 < 40 <= total.batches
    assert (total.input_rows, total.late_rows, total.missing_batches) == (42, 3, 0)


def test_each_of_many_batches_is_stored(spark, layout):
    """More than 200 batches, as fast as they come, more than a query remembers."""
    records(spark, [payload(f"e{k}", k) for k in range(840)]).repartition(210).write.parquet(layout.path("topic", "records"))
    listener, flushes = ev.BatchProgress(), []
    reader = spark.readStream.schema(ev.RECORD_SCHEMA).option("maxFilesPerTrigger", 1)
    listener.listen(spark)
    writer = ev.bronze_events(reader.parquet(layout.path("topic", "records"))).writeStream.format("noop")
    query = writer.option("checkpointLocation", layout.checkpoint("bronze", "t")).trigger(availableNow=True).start()
    ev.follow(query, listener, flushes.append)
    stored = [row for rows in flushes for row in rows]
    assert sorted(r[2] for r in stored) == list(range(210)) and sum(r[4] for r in stored) == 840
    assert len(flushes) > 1 and len(query.recentProgress) <= 101


def test_interrupt_stops_the_query_and_keeps_its_progress(spark, layout):
    put(spark, layout, [payload("a"), payload("b")])
    source = spark.readStream.schema(ev.RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    listener, stored = ev.BatchProgress(), []
    query = pipeline.start_bronze_stream(source, layout, listener=listener)

    class Interrupted:
        def __getattr__(self, name):
            return getattr(query, name)

        def awaitTermination(self, timeout):
            query.processAllAvailable()
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ev.follow(Interrupted(), listener, stored.extend)
    assert not query.isActive and sum(r[4] for r in stored) == 2


def test_two_streams_do_not_share_their_settings(spark, layout):
    put(spark, layout, [payload("a")])
    before = dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))
    drain(spark, layout)
    after = dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))
    assert before == after


def judged(spark, layout, **options):
    source = spark.readStream.schema(ev.RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(source, layout, drain=True).awaitTermination()
    schema = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE).schema
    listener = ev.BatchProgress()
    query = pipeline.start_judged_stream(spark, layout, schema, drain=True, state_partitions=2, listener=listener, **options)
    pipeline.follow_stream(spark, layout, pipeline.JUDGED_EVENTS, query, listener)
    return read_layer(spark, layout, pipeline.JUDGED_EVENTS, pipeline.EVENT_TABLE), str(query.id)


def test_every_event_has_one_fate(spark, layout):
    first = [payload("a"), payload("a"), payload("new", 3600), payload("hot", value=9999), "not json", None]
    # A refused event from the far future must not make the others late.
    first += [payload("far", 10**8, value=9999)]
    put(spark, layout, first)
    judged(spark, layout)
    put(spark, layout, [payload("late", 1), payload("a", 0), payload("b", 3500), payload("old", -10**6, value=9999)], 20)
    table, query = judged(spark, layout)
    rows = table.collect()
    assert sorted(r.event_id for r in rows if r["_verdict"] == "accepted") == ["a", "b", "new"]
    refused = {r.event_id: r.violations for r in rows if r["_verdict"] == "refused"}
    assert refused["hot"] == refused["far"] == refused["old"] == ["cross:value_in_type_range"]
    assert len(refused[None]) == 7 and sum(r["_verdict"] == "refused" for r in rows) == 5
    assert {r["_query"] for r in rows} == {f"q-{query}"} and len({r["_batch"] for r in rows}) == 2
    late = pipeline.stream_status(spark, layout, pipeline.JUDGED_EVENTS).first().late_rows
    bronze = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE)
    accounts = pipeline.stream_accounts(bronze, table, late).first()
    assert (accounts.rows, accounts.accepted, accounts.refused, accounts.late, accounts.copies) == (11, 3, 5, 2, 1)
    # The same batch once more replaces itself; a batch of another query is beside it.
    first = table.where("_batch = 0").drop("_query", "_batch")
    again = spark.createDataFrame(first.collect(), first.schema)
    assert not first.isEmpty()
    pipeline.store_judged(layout, again, query, 0)
    assert read_layer(spark, layout, pipeline.JUDGED_EVENTS, pipeline.EVENT_TABLE).count() == len(rows)
    pipeline.store_judged(layout, again, "other", 0)
    assert read_layer(spark, layout, pipeline.JUDGED_EVENTS, pipeline.EVENT_TABLE).count() == len(rows) + again.count()


def test_late_events_are_kept_with_their_fate(spark, layout):
    put(spark, layout, [payload("a"), payload("a"), payload("new", 3600), "junk"])
    judged(spark, layout, keep_late=True)
    edge = 3600 - 600
    second = [payload("lost", 1), payload("lost", 1), payload("edge", edge), payload("over", edge + 1), payload("a")]
    second += [payload("lost", 2), payload("old", 1, value=9999), payload("next", 9000)]
    put(spark, layout, second, 20)
    judged(spark, layout, keep_late=True)
    # These move the watermark on only afterwards, and are judged by what the batch before has left.
    put(spark, layout, [payload("then", 8500), payload("gone", 8000), payload("next", 9000)], 40)
    table, _ = judged(spark, layout, keep_late=True)
    assert sorted(r.event_id for r in table.where("_verdict = 'accepted'").collect()) == ["a", "new", "next", "over", "then"]
    fates = {r.kafka_offset: (r.event_id, r.fate) for r in pipeline.late_fates(table).collect()}
    lost = {20: "lost", 21: "lost", 22: "edge", 25: "lost", 41: "gone"}
    assert fates == {k: (v, "lost") for k, v in lost.items()} | {24: ("a", "copy")}
    row = pipeline.late_fates(table).where("kafka_offset = 20").first()
    assert (row.sensor_type, row.unit, row.value, row.kafka_partition) == ("ENERGY", "W", 5.0, 0)
    assert row.kafka_timestamp == T0 + timedelta(seconds=20)
    keys = {(r.event_id, r.event_timestamp): r.records for r in pipeline.late_keys(table).collect()}
    assert keys[("lost", T0 + timedelta(seconds=1))] == 2 and sum(keys.values()) == 5 and len(keys) == 4
    # Rows = accepted + refused + lost + copies, told by the stored table alone.
    late = pipeline.stream_status(spark, layout, pipeline.JUDGED_EVENTS).first().late_rows
    assert late == 6
    assert not pipeline.late_fates(table.where("_verdict != 'late'")).collect()


def test_an_accepted_event_in_the_late_table_is_not_late(spark):
    kinds = "event_id string, event_timestamp timestamp, kafka_topic string, kafka_partition int, kafka_offset long, violations array<string>, _verdict string, _query string, _batch long"
    rows = [("a", T0, "t", 0, 1, [], v, "q", 1) for v in ("accepted", "late")]
    rows += [("a", T0, "t", 0, 2, [], "late", "q", 1), ("b", T0, None, None, 3, [], "late", "q", 1)]
    rows += [("c", T0, None, None, None, [], v, "q", 1) for v in ("accepted", "late")]
    found = pipeline.late_fates(spark.createDataFrame(rows, kinds)).collect()
    assert {(r.kafka_offset, r.fate) for r in found} == {(2, "copy"), (3, "lost")}


def arrivals(spark, days):
    """Records that arrived on the given days of May 2024 (None: no time), by offset."""
    rows = [
        (b"1", payload(f"e{k}").encode(), "t", 0, k, None if d is None else datetime(2024, 5, d, 10) + timedelta(seconds=k // 2))
        for k, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, ev.RECORD_SCHEMA)


def by_day_table(spark, tmp_path, days):
    layout = Layout(str(tmp_path))
    arrivals(spark, days).write.parquet(layout.path("topic", "records"))
    source = spark.readStream.schema(ev.RECORD_SCHEMA).parquet(layout.path("topic", "records"))
    pipeline.start_bronze_stream(source, layout, drain=True, by_day=True).awaitTermination()
    return layout


@pytest.mark.parametrize(
    "days, read",
    [
        ([1] * 30 + [2] * 30 + [3] * 30, "2024-05-03"),  # the newest day is enough
        ([1] * 30 + [2] * 30 + [3] * 4, "2024-05-02"),  # two days are
        ([9, 8, 7, 6, 5, 4, 3, 2, 2, 2, 2, 1], "2024-05-02"),  # eight days, taken in steps
        ([None] * 20 + [4] * 3, None),  # no time: oldest
        ([5, 5], None),  # fewer than asked for
    ],
)
def test_newest_events_come_from_the_newest_days(spark, tmp_path, days, read):
    layout = by_day_table(spark, tmp_path, days)
    found = pipeline.newest_stored(spark, layout)
    whole = pipeline.latest_events(read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE))
    assert found.collect() == whole.collect() and found.count() == min(10, len(days))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert (f"arrival_day#" in plan and f">= {read}" in plan) if read else ">= " not in plan
    rows, newest = pipeline.stream_report(spark, layout)
    assert rows == len(days) and newest.collect() == whole.collect()


def test_arrival_day_does_not_hang_on_the_zone(spark):
    rows = spark.sql("select timestamp'2024-05-01 23:30:00Z' as kafka_timestamp union all select null")
    days = lambda: {str(r.arrival_day) for r in ev.by_arrival_day(rows).collect()}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for own in ("UTC", "Asia/Tokyo", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", own)
            assert days() == {"2024-05-01", "None"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_completeness_counts_a_repeated_batch_once(spark):
    def row(batch, at, n, counted):
        return ("q", "r", batch, at, n, 0, None, counted)

    rows = [
        row(0, "2024-05-01T00:00:00Z", 3, {"rows": 3, "unit": 1}),
        row(1, "2024-05-01T00:00:05Z", 2, {"rows": 2, "unit": 2}),
        row(1, "2024-05-01T00:01:00Z", 2, {"rows": 2, "unit": 2}),
        row(2, "2024-05-01T00:01:05Z", 0, {"rows": 0, "unit": 0}),
        row(3, "2024-05-01T00:01:10Z", 4, None),
    ]
    found = ev.stream_completeness(spark.createDataFrame(rows, ev.PROGRESS_SCHEMA))
    assert {r.what: r.n for r in found.collect()} == {"rows": 5, "unit": 3}
    assert ev.stream_completeness(spark.createDataFrame([], ev.PROGRESS_SCHEMA)).collect() == []

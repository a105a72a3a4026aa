"""The sensor event stream: records in, typed Bronze rows, clean Silver rows."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable, Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from millrace.plans.contract import accept, standardised
from millrace.plans.tables import SENSOR_EVENTS

# Record layout of the event topic, payload of one event, lateness allowance, pace.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("machine_id", T.IntegerType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
    ]
)
LATENESS = "10 minutes"
PACE = "5 seconds"

EVENT_KEY = ("event_id", "event_timestamp")
ARRIVAL_DAY = "arrival_day"
COMPLETENESS = "completeness"  # name of the metrics that travel with a batch's progress


def kafka_options(
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    records_per_task: int = 500_000,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxRecordsPerPartition": str(records_per_task),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **limits) -> DataFrame:
    """The topic as a stream.

    ``max_offsets`` keeps the first batches of a long backlog bounded. Records are keyed by machine, so one
    topic partition may hold most of them; ``records_per_task`` cuts its offset range into bounded tasks and
    drops nothing. With ``fail_on_data_loss`` the stream stops when records expired before they were read;
    otherwise it goes on without them.
    """
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets, **limits)).load()


def decode_envelope(records: DataFrame) -> DataFrame:
    """Kafka's binary record as readable columns; the payload stays as it came."""
    return records.selectExpr(
        "cast(key as string) as kafka_key",
        "cast(value as string) as raw_value",
        "topic as kafka_topic",
        "partition as kafka_partition",
        "offset as kafka_offset",
        "timestamp as kafka_timestamp",
    )


def parse_events(decoded: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Add the payload's fields; whatever cannot be parsed is NULL and the raw text is kept."""
    parsed = decoded.withColumn("_payload", F.from_json("raw_value", schema))
    return parsed.select(*decoded.columns, "_payload.*")


def bronze_events(records: DataFrame) -> DataFrame:
    return parse_events(decode_envelope(records)).withColumn("_ingestion_timestamp", F.current_timestamp())


def by_arrival_day(bronze: DataFrame) -> DataFrame:
    """With the day a record reached the topic, in UTC whatever the session's zone, so days never run against times."""
    day = f"date_from_unix_date(int(floor(unix_seconds(kafka_timestamp) / 86400))) as {ARRIVAL_DAY}"
    return bronze.selectExpr("*", day)


def observed(bronze: DataFrame) -> DataFrame:
    """The same rows; how many a batch has, and its nulls in each payload field, are counted in passing."""
    fields = ["raw_value", *EVENT_SCHEMA.fieldNames()]
    nulls = (F.expr(f"count_if({c} is null) as {c}") for c in fields)
    return bronze.observe(COMPLETENESS, F.expr("count(1) as rows"), *nulls)


def dedupe_stream(
    events: DataFrame, keys: Sequence[str], time: str, delay: str, salts: int = 1, salt_on: str | None = None
) -> DataFrame:
    """The first arrival per ``keys`` within the watermark; later copies and late rows are dropped.

    ``keys`` holds the event time, so state can be evicted. With ``salts`` > 1 a first pass drops copies per
    (keys, salt): a storm of copies of one event is then shared by that many tasks, and the second pass sees
    at most ``salts`` of them. The salt is taken from a column of the row, so a replayed batch salts alike.
    """
    timed = events.withWatermark(time, delay)
    if salts > 1:
        salt = F.pmod(F.xxhash64(salt_on), F.lit(salts))
        timed = timed.withColumn("_salt", salt).dropDuplicates([*keys, "_salt"]).drop("_salt")
    return timed.dropDuplicates(list(keys))


def behind_watermark(events: DataFrame, time: str, delay: str, order: Sequence[str], groups: int = 256) -> DataFrame:
    """The rows of a stream that came behind the watermark, which every built-in operator drops in silence.

    Among them are all that :func:`dedupe_stream` of the same query drops as late. That looks at the watermark of the
    batch before, this at the batch's own, so a few rows may be here that are also accepted. No other rows pass. The
    watermark is only told to a function with state, so rows go through Python in Arrow batches: hand over no more
    columns than are wanted. Rows are dealt to ``groups`` by the hash of ``order``, so no key makes a large group, and
    no group keeps state of any size. A row without a time is never late.
    """

    def late(_, batches, state):
        mark = state.getCurrentWatermarkMs() * 1000
        for rows in batches:
            yield rows[rows["_micros"] <= mark].drop(columns=["_group", "_micros"])

    timed = events.withWatermark(time, delay)
    timed = timed.withColumns(
        {
            "_group": F.pmod(F.xxhash64(*order), F.lit(groups)),
            "_micros": F.expr(f"coalesce(unix_micros({time}), 9223372036854775807L)"),
        }
    )
    return timed.groupBy("_group").applyInPandasWithState(late, events.schema, "seen long", "append", "NoTimeout")


def late_events(valid: DataFrame) -> DataFrame:
    """Valid events that came behind the watermark. Only the record goes through Python, as text; it is parsed anew."""
    numbers = ["kafka_partition", "kafka_offset"]
    record = ["kafka_key", "raw_value", "kafka_topic", *numbers, "kafka_timestamp"]
    texts = [f"cast({c} as string) as {c}" if c in numbers else c for c in record]
    told = valid.selectExpr(*texts, "event_timestamp as _time")
    late = behind_watermark(told, "_time", LATENESS, ["kafka_topic", *numbers])
    kinds = dict(valid.dtypes)
    typed = late.selectExpr(*(f"cast({c} as {kinds[c]}) as {c}" if c in numbers else c for c in record))
    return standardised(parse_events(typed), SENSOR_EVENTS)


def clean_events(bronze: DataFrame, salts: int = 16) -> DataFrame:
    """Silver events: contract, watermark, dedup, quality mark. Works on a stream and on a batch frame."""
    valid = accept(bronze, SENSOR_EVENTS)
    unique = dedupe_stream(valid, EVENT_KEY, "event_timestamp", LATENESS, salts, "kafka_offset")
    return unique.withColumns(
        {"_silver_processed_at": F.current_timestamp(), "_data_quality_status": F.lit("VALID")}
    )


def judged_events(bronze: DataFrame, salts: int = 16, keep_late: bool = False) -> DataFrame:
    """Silver events and, beside them, the refused ones with the rules they broke; ``_verdict`` tells them apart.

    Copies and late rows of valid events are dropped, as in :func:`clean_events`; nothing of the refused is. They carry
    no state and no watermark, so what is wrong with them (a time in the far future) has no effect on the others.
    With ``keep_late`` (streams only) the events behind the watermark follow as ``late``.
    """
    accepted = clean_events(bronze, salts).selectExpr("*", "array() as violations", "'accepted' as _verdict")
    tidy = standardised(bronze, SENSOR_EVENTS).where(f"not ({SENSOR_EVENTS.accepted()})")
    refused = tidy.selectExpr("*", f"{SENSOR_EVENTS.violations()} as violations", "'refused' as _verdict")
    judged = accepted.unionByName(refused, allowMissingColumns=True)
    if not keep_late:
        return judged
    late = late_events(accept(bronze, SENSOR_EVENTS)).selectExpr("*", "array() as violations", "'late' as _verdict")
    return judged.unionByName(late, allowMissingColumns=True)


def start_batches(
    df: DataFrame,
    store: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    pace: str = PACE,
    drain: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to ``store(rows, query id, batch id)``, which must take a repeated batch for the same."""

    def batch(rows: DataFrame, number: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store(rows, query, number)

    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=pace)
    return writer.start()


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    pace: str = PACE,
    drain: bool = False,
    partitions: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a table, resuming from ``checkpoint`` with every row written once.

    ``drain`` works off what is there and stops; otherwise a micro-batch starts every ``pace``. File formats get
    one file a partition and batch: at a short pace use a table format that compacts.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*partitions) if partitions else writer
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=pace)
    return writer.start(path)


PROGRESS_SCHEMA = (
    "query_id string, run_id string, batch_id long, batch_timestamp string, input_rows long, late_rows long,"
    " watermark string, counted map<string, long>"
)


def progress_row(p: StreamingQueryProgress) -> tuple:
    late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
    seen = p.observedMetrics.get(COMPLETENESS)
    place = (str(p.id), str(p.runId), p.batchId, p.timestamp)
    return (*place, p.numInputRows, late, p.eventTime.get("watermark"), seen.asDict() if seen else None)


class BatchProgress(StreamingQueryListener):
    """Hears of every batch of the streams of a session, from before they start; rows wait until they are taken."""

    def __init__(self) -> None:
        self._rows: dict[str, deque[tuple]] = defaultdict(deque)
        self._ended: dict[str, Event] = defaultdict(Event)
        self._streams = None

    def listen(self, spark: SparkSession) -> None:
        """Hear of the streams this session starts from now on."""
        self._streams = spark.streams
        self._streams.addListener(self)

    def close(self) -> None:
        if self._streams:
            self._streams.removeListener(self)
            self._streams = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress)
        self._rows[row[1]].append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def take(self, query: StreamingQuery) -> list[tuple]:
        waiting = self._rows[str(query.runId)]
        return [waiting.popleft() for _ in range(len(waiting))]

    def heard_all(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until the end of a query was reported: its last batch was reported before."""
        return self._ended[str(query.runId)].wait(seconds)


def follow(
    query: StreamingQuery, listener: BatchProgress, store: Callable[[list[tuple]], None], flush: int = 50
) -> None:
    """Wait for a query to end and hand the progress of every batch to ``store``.

    ``listener`` listened to the query's session before the query started, so it hears of each batch, however many
    there are and however fast they come. ``flush`` batches are stored at a time; the rest when the query ends, also by
    an error. An interrupt stops the query in order first.
    """
    waiting: list[tuple] = []
    try:
        while not query.awaitTermination(1.0):
            waiting += listener.take(query)
            if len(waiting) >= flush:
                store(waiting)
                waiting = []
    finally:
        if query.isActive:
            query.stop()
        listener.heard_all(query)
        listener.close()
        waiting += listener.take(query)
        if waiting:
            store(waiting)


def stream_totals(progress: DataFrame) -> DataFrame:
    """One row over the stored progress of a stream's whole life, restarts included.

    A batch that was repeated after a restart counts once, by its latest attempt that saw rows. ``missing_batches``
    is how many batch numbers were never stored, because a driver was lost before it could.
    """
    attempt = "max_by(struct(input_rows, late_rows, watermark), struct(input_rows > 0, batch_timestamp)) as b"
    batches = progress.groupBy("query_id", "batch_id").agg(F.expr(attempt))
    return batches.selectExpr("query_id", "batch_id", "b.*").groupBy("query_id").agg(
        F.expr("count(1) as batches"),
        F.expr("max(batch_id) + 1 - count(1) as missing_batches"),
        F.expr("sum(input_rows) as input_rows"),
        F.expr("sum(late_rows) as late_rows"),
        F.expr("max(watermark) as watermark"),
    )


def stream_completeness(progress: DataFrame) -> DataFrame:
    """Nulls by payload field, and ``rows``, over the stored progress of a stream's whole life: ``what, n``.

    Nothing of the events is read. A repeated batch counts once, as in :func:`stream_totals`; batches of streams
    that count nothing add nothing.
    """
    attempt = "max_by(counted, struct(input_rows > 0, batch_timestamp)) as counted"
    batches = progress.where("counted is not null").groupBy("query_id", "batch_id").agg(F.expr(attempt))
    return batches.selectExpr("explode(counted) as (what, n)").groupBy("what").agg(F.expr("sum(n) as n"))


def stream_status(query: StreamingQuery) -> dict[str, object]:
    """State of a running query; its totals are in the stored progress."""
    error = query.exception()
    return {
        "active": query.isActive,
        "status": query.status.get("message"),
        "error": str(error) if error else None,
        "last_batch": query.lastProgress.batchId if query.lastProgress else None,
    }

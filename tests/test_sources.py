"""Layer tables, insert-if-absent on a layer, JDBC options, publication."""

from __future__ import annotations

import pytest

from millrace import session
from millrace.operators.quality import QualityError
from millrace.sources import jdbc, layers
from millrace.session import scratch_folder


def test_write_checked_round_trip(spark, layout):
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 as g", "cast(id as decimal(14,3)) as d")
    assert layers.write_checked(df, layout, "gold", "t") == 1000
    back = layers.read_layer(spark, layout, "gold", "t")
    assert back.schema == df.selectExpr("id", "g", "d").schema.__class__(
        [f.__class__(f.name, f.dataType, True) for f in df.schema]
    )
    assert back.exceptAll(df).isEmpty()


def test_overwrite_replaces_rows_and_schema(spark, layout):
    layers.write_layer(spark.range(5), layout, "gold", "t")
    layers.write_layer(spark.range(2).selectExpr("id as other"), layout, "gold", "t")
    back = layers.read_layer(spark, layout, "gold", "t")
    assert back.columns == ["other"] and back.count() == 2


def test_write_checked_notices_lost_rows(spark, layout, monkeypatch):
    real = layers.read_layer
    monkeypatch.setattr(layers, "read_layer", lambda *a: real(*a).limit(3))
    with pytest.raises(QualityError, match="expected 5 rows, found 3"):
        layers.write_checked(spark.range(5), layout, "gold", "t")


def test_insert_if_absent_appends_only_new_keys(spark, layout):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "code string, n int")
    layers.write_layer(old, layout, "silver", "t")
    new = spark.createDataFrame([("b", 9), ("c", 4), ("c", 3)], "code string, n int")
    for _ in range(2):
        layers.insert_if_absent(new, layout, "silver", "t", "code")
        rows = {(r.code, r.n) for r in layers.read_layer(spark, layout, "silver", "t").collect()}
        assert rows == {("a", 1), ("b", 2), ("c", 3)}


def test_scratch_folder_is_below_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(root) and first != second


CONN = jdbc.JdbcConnection("jdbc:postgresql://host/db", "u", "secret", schema="operations")


def test_scan_options():
    plain = jdbc.scan_options(CONN, "alerts")
    assert plain["dbtable"] == "operations.alerts" and plain["fetchsize"] == "10000"
    assert "partitionColumn" not in plain


def test_ranges_hold_every_row_once(spark):
    # One outlier key, gaps, copies and a null: quantile bounds keep the parts even.
    keys = [*range(1, 400), 10**15, 500, 500, None]
    tiles = [keys[:-1][k * 402 // 8 : (k + 1) * 402 // 8] for k in range(8)]
    predicates = jdbc.range_predicates("k", [max(t) for t in (sorted(t) for t in tiles)][:-1])
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    parts = [df.where(p).count() for p in predicates]
    assert sum(parts) == len(keys) and max(parts) <= 2 * len(keys) / len(predicates)
    assert jdbc.range_predicates("k", []) == ["1 = 1"]
    assert jdbc.range_predicates("d", ["2024-01-01"]) == ["d <= '2024-01-01' or d is null", "d > '2024-01-01'"]


def test_publish_options():
    options = jdbc.publish_options(CONN, "dim_machines", truncate=True, connections=8)
    assert options["batchsize"] == "5000" and options["truncate"] == "true" and options["numPartitions"] == "8"
    with pytest.raises(TypeError):
        jdbc.JdbcTarget(CONN)


def test_password_is_not_shown():
    assert "secret" not in repr(CONN)


class FolderTarget:
    """Stands in for the serving database."""

    def __init__(self, layout, lose=0):
        self.layout, self.lose = layout, lose

    def write(self, df, table):
        layers.write_layer(df, self.layout, "served", table)

    def count(self, spark, table):
        return layers.read_layer(spark, self.layout, "served", table).count() - self.lose


def test_publish_checks_counts(spark, layout):
    assert jdbc.publish(spark.range(7), FolderTarget(layout), "t") == 7
    with pytest.raises(QualityError):
        jdbc.publish(spark.range(7), FolderTarget(layout, lose=1), "t")
    with pytest.raises(QualityError):
        jdbc.publish(spark.range(0), FolderTarget(layout), "t")


class RecordingReader:
    """Takes the place of ``spark.read``: keeps what was asked of it and answers with a prepared frame."""

    def __init__(self, answers):
        self.answers, self.asked = answers, []

    def format(self, fmt):
        self.fmt = fmt
        return self

    def options(self, **options):
        self.current = options
        return self

    def jdbc(self, url, table, predicates, properties):
        self.asked.append(("jdbc", {"url": url, "dbtable": table, "predicates": predicates, **properties}))
        return self.answers[len(self.asked) - 1]

    def load(self):
        self.asked.append((self.fmt, self.current))
        return self.answers[len(self.asked) - 1]


class StubSession:
    def __init__(self, spark, *answers):
        self.read = self.readStream = RecordingReader(answers)
        self.sparkContext = spark.sparkContext


def test_source_asks_for_quantiles_then_scans_in_ranges(spark):
    bounds = spark.createDataFrame([(2, 900), (1, 40), (3, 10**15)], "tile int, high long")
    stub = StubSession(spark, bounds, spark.range(3))
    assert jdbc.JdbcSource(CONN, 3, {"alerts": "alert_id"}).read(stub, "alerts").count() == 3
    (_, asked), (fmt, scan) = stub.read.asked
    assert "ntile(3) over (order by alert_id)" in asked["dbtable"] and "operations.alerts" in asked["dbtable"]
    assert fmt == "jdbc" and scan["dbtable"] == "operations.alerts" and scan["fetchsize"] == "10000"
    assert scan["predicates"] == ["alert_id <= 40 or alert_id is null", "alert_id > 40 and alert_id <= 900", "alert_id > 900"]


def test_given_predicates_empty_and_unsplit_tables(spark):
    stub = StubSession(spark, spark.range(1))
    jdbc.JdbcSource(CONN, 3, {"alerts": "alert_id"}, {"alerts": ["a = 1", "a <> 1"]}).read(stub, "alerts")
    assert stub.read.asked[0][1]["predicates"] == ["a = 1", "a <> 1"]
    stub = StubSession(spark, spark.createDataFrame([], "tile int, high long"), spark.range(0))
    jdbc.JdbcSource(CONN, 3, {"alerts": "alert_id"}).read(stub, "alerts")
    assert stub.read.asked[1][1]["predicates"] == ["1 = 1"]
    for source, table in ((jdbc.JdbcSource(CONN, 3, {"alerts": "alert_id"}), "workshops"), (jdbc.JdbcSource(CONN, 1, {"t": "k"}), "t")):
        stub = StubSession(spark, spark.range(1))
        source.read(stub, table)
        assert len(stub.read.asked) == 1 and "predicates" not in stub.read.asked[0][1]


def test_read_kafka_subscribes(spark):
    from millrace.streaming.events import read_kafka

    stub = StubSession(spark, spark.range(1))
    read_kafka(stub, "h:9092", "sensor-readings")
    assert stub.read.asked == [
        (
            "kafka",
            {
                "kafka.bootstrap.servers": "h:9092",
                "subscribe": "sensor-readings",
                "startingOffsets": "earliest",
                "failOnDataLoss": "false",
                "maxRecordsPerPartition": "500000",
            },
        )
    ]


def test_target_counts_in_the_database(spark):
    stub = StubSession(spark, spark.createDataFrame([(41,)], "n long"))
    assert jdbc.JdbcTarget(CONN, 4).count(stub, "dim_machines") == 41
    assert stub.read.asked[0][1]["dbtable"] == "(select count(*) as n from operations.dim_machines) counted"

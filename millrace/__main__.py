"""Run one job: ``spark-submit`` this module, or ``python -m millrace JOB --root ROOT ...``.

The JDBC password is taken from the environment variable named by ``--password-env``. A failed job raises, so
the process ends with a non-zero exit code.
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace.plans import pipeline
from millrace.session import build_session
from millrace.sources.jdbc import JdbcConnection, JdbcTarget
from millrace.sources.layers import Layout, read_layer
from millrace.streaming.events import BatchProgress, read_kafka

STORE_JOBS = ("bronze", "publish", "batch")
STREAM_JOBS = ("stream-bronze", "stream-silver")


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    others = ("silver", "gold", "validate", "stream-report", "stream-status")
    parser.add_argument("job", choices=(*STORE_JOBS, *others, *STREAM_JOBS))
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--format", default="parquet", help="table format of the layers")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--user")
    parser.add_argument("--password-env", default="MILLRACE_PASSWORD")
    parser.add_argument("--source-schema", default="operations")
    parser.add_argument("--target-schema", default="analytics")
    parser.add_argument("--connections", type=int, help="what the databases take at once, reading and writing")
    parser.add_argument("--shuffle-partitions", type=int, help="shuffle partitions AQE starts from before it merges")
    parser.add_argument("--keep-rejected", action="store_true", help="also write rejected rows")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic")
    parser.add_argument("--max-offsets", type=int, help="records per micro-batch from Kafka")
    parser.add_argument("--records-per-task", type=int, default=500_000, help="cut longer Kafka offset ranges")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="stop when Kafka records expired unread")
    parser.add_argument("--max-files", type=int, help="files per micro-batch from the streaming Bronze table")
    parser.add_argument("--state-partitions", type=int, help="partitions of the dedup state, fixed by the first start")
    parser.add_argument("--drain", action="store_true", help="work off what is there and stop")
    parser.add_argument("--by-day", action="store_true", help="partition streaming Bronze by day of arrival")
    found = parser.parse_args(argv)
    needed = ["jdbc_url", "user", "connections"] if found.job in STORE_JOBS else []
    needed += ["servers", "topic"] if found.job == "stream-bronze" else []
    missing = [f"--{n.replace('_', '-')}" for n in needed if not getattr(found, n)]
    if missing:
        parser.error(f"{found.job} needs {', '.join(missing)}")
    return found


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    layout = Layout(args.root, args.format)
    if args.job in STORE_JOBS:
        password = os.environ[args.password_env]
        source, serving = (
            JdbcConnection(args.jdbc_url, args.user, password, schema=schema)
            for schema in (args.source_schema, args.target_schema)
        )
        store = pipeline.operational_store(source, args.connections)
        target = JdbcTarget(serving, args.connections)
        if args.job == "bronze":
            return pipeline.run_bronze(spark, layout, store)
        if args.job == "publish":
            return pipeline.run_publish(spark, layout, target)
        return pipeline.run_batch(spark, layout, store, target, keep_rejected=args.keep_rejected)
    if args.job == "silver":
        counts = pipeline.run_silver(spark, layout, keep_rejected=args.keep_rejected)
        return {**counts, "total": pipeline.total(counts)}
    if args.job in ("gold", "validate"):
        counts = (pipeline.run_gold if args.job == "gold" else pipeline.run_validate)(spark, layout)
        return {**counts, "total": sum(counts.values())}
    if args.job == "stream-status":
        for layer in (pipeline.BRONZE_EVENTS, pipeline.SILVER_EVENTS):
            pipeline.stream_status(spark, layout, layer).show(truncate=False)
        return None
    if args.job == "stream-report":
        count, newest = pipeline.stream_report(spark, layout)
        newest.show(truncate=False)
        return count
    listener = BatchProgress()
    if args.job == "stream-bronze":
        limits = {"records_per_task": args.records_per_task, "fail_on_data_loss": args.fail_on_data_loss}
        topic = read_kafka(spark, args.servers, args.topic, args.max_offsets, **limits)
        query = pipeline.start_bronze_stream(topic, layout, args.drain, listener, args.by_day)
    else:
        bronze = read_layer(spark, layout, pipeline.BRONZE_EVENTS, pipeline.EVENT_TABLE)
        query = pipeline.start_silver_stream(
            spark, layout, bronze.schema, args.drain, args.max_files, args.state_partitions, listener
        )
    layer = pipeline.BRONZE_EVENTS if args.job == "stream-bronze" else pipeline.SILVER_EVENTS
    pipeline.follow_stream(spark, layout, layer, query, listener)
    return query.id


def main() -> None:
    args = arguments()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = build_session(f"millrace-{args.job}", args.shuffle_partitions)
    try:
        print(f"{args.job}: {run(spark, args)}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

"""Command line: ``python -m evstar <command> ...``.

  ingest         drain the topic into the lake and the quarantine
  load           load new lake files into the raw events table
  build          build and test the models from the raw tables
  run            ingest, load and build in one go
  snapshot       store a catalog export (JSON array file) as a dated snapshot
  inspect-lake   files, schema and counts of the lake
  inspect-topic  spread of messages and keys over the topic's partitions

Paths are folders on the cluster's shared storage; ``--root`` holds the
whole deployment (see ``evstar.plans.pipeline.Layout``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from .operators import profiling
from .plans import marts
from .plans.build import BuildFailed
from .plans.pipeline import Layout, run_pipeline
from .session import get_session
from .sources import catalogs, lake, topic
from .streaming.ingest import ingest
from .streaming.load import load_raw


def _topic_stream(spark, args):
    # The batch rule is for a query that keeps running: a bounded run must not
    # hold back a tail that is shorter than a batch.
    keeps_running = getattr(args, "continuous", False)
    return topic.read_topic(
        spark,
        args.bootstrap_servers,
        args.topic,
        flush_rows=topic.FLUSH_ROWS if keeps_running else None,
        flush_delay=topic.FLUSH_DELAY if keeps_running else None,
        min_partitions=args.min_partitions,
        max_rows_per_batch=args.max_rows_per_batch,
    )


def cmd_ingest(spark, args):
    layout = Layout(args.root)
    q = ingest(
        _topic_stream(spark, args),
        layout.lake,
        layout.dead_letter,
        layout.checkpoint("ingest"),
        available_now=not args.continuous,
        files_per_batch=args.files_per_batch,
    )
    q.awaitTermination()


def cmd_load(spark, args):
    layout = Layout(args.root)
    n = load_raw(spark, layout.lake, layout.raw_events, layout.checkpoint("load"))
    print(f"loaded {n} rows into {layout.raw_events}")


def _calendar(args):
    return None if args.calendar_from_data else (args.calendar_start, args.calendar_end)


def cmd_run(spark, args):
    result = run_pipeline(
        spark,
        _topic_stream(spark, args),
        Layout(args.root),
        calendar=_calendar(args),
        fail_fast=not args.report,
        incremental_staging=args.incremental_staging,
        incremental_catalogs=args.incremental_catalogs,
    )
    for name, n in result.results:
        print(f"{'PASS' if n == 0 else 'FAIL'} {name} ({n})")


def cmd_build(spark, args):
    from .plans.build import build
    from .streaming.load import read_raw_events

    layout = Layout(args.root)
    raw = read_raw_events(spark, layout.raw_events)
    calendar = _calendar(args)
    if calendar is None:
        from .functions.calendar import date_spine_covering

        cal = marts.dim_date(spine=date_spine_covering(raw.filter(F.col("event_type") == "order"), "event_timestamp"))
    else:
        cal = marts.dim_date(spark, *calendar)
    result = build(
        spark,
        raw,
        catalogs.read_snapshots(spark, layout.catalogs, "products"),
        catalogs.read_snapshots(spark, layout.catalogs, "customers"),
        layout.warehouse,
        calendar=cal,
        fail_fast=not args.report,
    )
    for name, n in result.results:
        print(f"{'PASS' if n == 0 else 'FAIL'} {name} ({n})")


def cmd_snapshot(spark, args):
    layout = Layout(args.root)
    day = args.date or dt.datetime.now(dt.timezone.utc).date().isoformat()
    catalogs.write_snapshot(catalogs.read_export(spark, args.name, args.file), layout.catalogs, args.name, day)
    print(f"stored {args.file} as {args.name} snapshot {day}")


def _print_rows(df) -> None:
    """Every row, one line each, fetched partition by partition."""
    for row in df.toLocalIterator():
        print("  " + "\t".join(str(v) for v in row))


def cmd_inspect_lake(spark, args):
    root = Layout(args.root).lake
    files = profiling.lake_files(spark, root)
    df = lake.read_lake(spark, root)
    s = profiling.lake_summary(df).first()
    print(f"files={files.count()} rows={s.total_rows} events={s.distinct_event_ids} repeated={s.duplicate_rows}")
    for title, rows in (
        ("columns", profiling.schema_report(spark, df)),
        ("newest paths (bytes)", profiling.latest_files(files)),
        ("events by type", profiling.rows_per_type(df)),
    ):
        print(f"{title}:")
        _print_rows(rows)


def cmd_inspect_topic(spark, args):
    df = topic.read_topic(spark, args.bootstrap_servers, args.topic, streaming=False).withColumn(
        "key", F.col("key").cast("string")
    )
    s = profiling.key_summary(df).first()
    print(f"keys={s.distinct_keys} keyless={s.messages_without_key}")
    for title, rows in (
        ("messages by partition", profiling.partition_counts(df)),
        ("keys that break affinity", profiling.key_affinity(df)),
    ):
        print(f"{title}:")
        _print_rows(rows)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="evstar", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None, help="Spark master (leave unset under spark-submit)")
    ap.add_argument("--cluster", action="store_true", help="apply the large-cluster sizing profile")
    sub = ap.add_subparsers(dest="command", required=True)

    def with_topic(p):
        p.add_argument("--bootstrap-servers", default="localhost:9092")
        p.add_argument("--topic", default=topic.TOPIC)
        p.add_argument("--min-partitions", type=int, default=None)
        p.add_argument("--max-rows-per-batch", type=int, default=None, help="cap on messages per micro-batch")

    def with_calendar(p):
        p.add_argument("--report", action="store_true", help="run every check and report, do not stop")
        p.add_argument("--calendar-start", default=marts.DEFAULT_CALENDAR[0])
        p.add_argument("--calendar-end", default=marts.DEFAULT_CALENDAR[1])
        p.add_argument("--calendar-from-data", action="store_true", help="size the calendar to the orders")

    p = sub.add_parser("ingest")
    p.add_argument("--root", required=True)
    p.add_argument("--continuous", action="store_true", help="keep running (default: drain and stop)")
    p.add_argument("--files-per-batch", type=int, default=None)
    with_topic(p)
    p = sub.add_parser("load")
    p.add_argument("--root", required=True)
    p = sub.add_parser("build")
    p.add_argument("--root", required=True)
    with_calendar(p)
    p = sub.add_parser("run")
    p.add_argument("--root", required=True)
    p.add_argument("--incremental-staging", action="store_true", help="stage only newly loaded orders")
    p.add_argument("--incremental-catalogs", action="store_true", help="merge only new catalog snapshots")
    with_topic(p)
    with_calendar(p)
    p = sub.add_parser("snapshot")
    p.add_argument("--root", required=True)
    p.add_argument("--name", choices=sorted(catalogs.CATALOG_SCHEMAS), required=True)
    p.add_argument("--file", required=True, help="JSON array export of the catalog")
    p.add_argument("--date", default=None, help="snapshot date (default: today, UTC)")
    p = sub.add_parser("inspect-lake")
    p.add_argument("--root", required=True)
    p = sub.add_parser("inspect-topic")
    with_topic(p)

    args = ap.parse_args(argv)
    spark = get_session(args.master, app=f"evstar-{args.command}", cluster=args.cluster)
    handlers = {
        "ingest": cmd_ingest,
        "load": cmd_load,
        "build": cmd_build,
        "run": cmd_run,
        "snapshot": cmd_snapshot,
        "inspect-lake": cmd_inspect_lake,
        "inspect-topic": cmd_inspect_topic,
    }
    try:
        handlers[args.command](spark, args)
    except BuildFailed as e:
        print(f"BUILD FAILED: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

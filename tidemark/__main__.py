"""Command line: ``python -m tidemark ingest|marts|batch|report|refresh|late|upsert|insert|stream ...``"""

from __future__ import annotations

import argparse
import logging

from tidemark.operators.merge import UPSERT_COLUMNS
from tidemark.operators.rules import load_declaration
from tidemark.plans.ingest import (
    log_late_events,
    refresh_snapshot,
    run_batch,
    run_batch_ingestion,
)
from tidemark.plans.marts import run_transformations
from tidemark.plans.reports import REPORTS, run_report
from tidemark.plans.writes import insert_rows, upsert_rows
from tidemark.schemas import ENTITIES
from tidemark.session import build_session
from tidemark.sources.streams import kafka_messages
from tidemark.sources.tables import read_source, register_views
from tidemark.streaming import fork, pipelines

PROFILES = ["record", "stream", "declared"]


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="batch files to silver")
    ingest.add_argument("--input-dir", default="data/batch")
    ingest.add_argument("--output-base", default="data")
    ingest.add_argument("--profile", choices=PROFILES)
    ingest.add_argument("--rules", help="YAML rule declaration, for the declared profile")

    marts = commands.add_parser("marts", help="silver to gold")
    marts.add_argument("--silver-base", default="data/silver")
    marts.add_argument("--gold-base", default="data/gold")

    batch = commands.add_parser("batch", help="the whole batch sequence")
    batch.add_argument("--input-dir", default="data/batch")
    batch.add_argument("--data-dir", default="data")
    batch.add_argument("--profile", choices=PROFILES, default="record")
    batch.add_argument("--rules", help="YAML rule declaration, for the declared profile")
    batch.add_argument("--no-gate", action="store_true", help="go on whatever the quality")

    report = commands.add_parser("report", help="analytical reports")
    report.add_argument("--query", choices=[*REPORTS, "all"], default="all")
    report.add_argument("--data-dir", default="data")

    for name, text in (("refresh", "change log to snapshot"), ("late", "log of late events")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--table", choices=list(ENTITIES), required=True)
        command.add_argument("--data-dir", default="data")
        if name == "late":
            command.add_argument("--delay-minutes", type=float, default=10)

    for name, text in (("upsert", "rows over known keys"), ("insert", "rows of unknown keys")):
        command = commands.add_parser(name, help=f"merge a batch file into its keyed table: {text}")
        command.add_argument("--table", choices=sorted(UPSERT_COLUMNS), required=True)
        command.add_argument("--input-dir", default="data/batch")
        command.add_argument("--data-dir", default="data")

    stream = commands.add_parser("stream", help="change topics to silver and errors")
    stream.add_argument("--bootstrap-servers", required=True)
    stream.add_argument("--table", choices=list(ENTITIES), action="append", help="default: all")
    stream.add_argument("--output-base", required=True)
    stream.add_argument("--checkpoint-base", required=True)
    stream.add_argument("--profile", choices=PROFILES, default="record")
    stream.add_argument("--rules", help="YAML rule declaration, for the declared profile")
    stream.add_argument("--trigger", default="5 seconds", help="an interval, or availableNow")
    stream.add_argument("--max-offsets", type=int, default=1_000_000, help="per micro-batch")
    stream.add_argument("--delay", default=pipelines.DEFAULT_DELAY, help="of duplicates, or none")
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--run-id")
    forms = stream.add_mutually_exclusive_group()
    forms.add_argument("--two-queries", action="store_true", help="a query for each side")
    forms.add_argument("--single-query", action="store_true", help="both sides in one table")
    forms.add_argument("--keep-state", action="store_true", help="keep the latest rows as well")
    stream.add_argument("--land-bronze", action="store_true", help="keep the messages too")
    return parser


def start_streams(spark, args, messages_of) -> list:
    """The queries of a ``stream`` command. ``messages_of(entity)`` gives its messages."""
    trigger = (
        {"availableNow": True}
        if args.trigger == "availableNow"
        else {"processingTime": args.trigger}
    )
    options = {
        "profile": args.profile,
        "delay": None if args.delay == "none" else args.delay,
        "trigger": trigger,
        "run_id": args.run_id,
        "state_partitions": args.state_partitions,
        "declaration": load_declaration(args.rules) if args.rules else None,
    }
    queries = []
    for table in args.table or list(ENTITIES):
        messages = messages_of(ENTITIES[table])
        places = (messages, table, args.output_base, args.checkpoint_base)
        if args.single_query:
            queries.append(pipelines.process_stream_once(spark, *places, **options))
        elif args.two_queries:
            queries += pipelines.process_stream(spark, *places, **options)
        else:
            kept = {"keep_state": args.keep_state}
            queries.append(fork.process_stream_fork(spark, *places, **options, **kept))
        if args.land_bronze:
            bronze = f"{args.output_base.rstrip('/')}/bronze/{table}"
            state = f"{args.checkpoint_base.rstrip('/')}/{table}_bronze"
            queries.append(pipelines.land_messages(messages, bronze, state, trigger))
    return queries


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"tidemark-{args.command}", streaming=args.command == "stream")
    rules = load_declaration(args.rules) if getattr(args, "rules", None) else None
    if args.command == "ingest":
        run_batch_ingestion(spark, args.input_dir, args.output_base, args.profile, rules)
    elif args.command == "marts":
        run_transformations(spark, args.silver_base, args.gold_base)
    elif args.command == "batch":
        run_batch(spark, args.input_dir, args.data_dir, args.profile, not args.no_gate, rules)
    elif args.command == "refresh":
        refresh_snapshot(spark, args.data_dir, args.table)
    elif args.command == "late":
        log_late_events(spark, args.data_dir, args.table, round(args.delay_minutes * 60_000))
    elif args.command in ("upsert", "insert"):
        rows = read_source(spark, args.input_dir, args.table)
        if rows is None:
            raise SystemExit(f"no file of {args.table} in {args.input_dir}")
        write = upsert_rows if args.command == "upsert" else insert_rows
        merged = write(spark, args.data_dir, args.table, rows)
        logging.info("%s: version %s", args.table, merged.version)
    elif args.command == "report":
        register_views(spark, args.data_dir)
        for name in REPORTS if args.query == "all" else [args.query]:
            print(name)
            show(run_report(spark, name))
    elif args.command == "stream":

        def messages_of(entity):
            return kafka_messages(spark, args.bootstrap_servers, entity, args.max_offsets)

        pipelines.await_all(spark, start_streams(spark, args, messages_of))


def show(report) -> None:
    """Print all rows of a report, fetched part by part in their order."""
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


if __name__ == "__main__":
    main()

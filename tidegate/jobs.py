"""Command line of the three jobs, for spark-submit.

    python -m tidegate.jobs bronze --root ... --source ... [--minutes 15 | --once]
    python -m tidegate.jobs silver --root ... --templates assets.json --template-folder ...
    python -m tidegate.jobs reset  --root ... --layer silver [--yes]
"""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidegate.config import SESSION_CONF, Layout, RunConfig
from tidegate.maintenance import Reset, compact_layer, reset_layer
from tidegate.operators.compact import GOAL
from tidegate.sources.replay import (
    between_positions,
    bus_stream,
    first_start,
    kafka_options,
    kafka_stream,
    landing_schema,
)
from tidegate.sources.templates import Template, compile_templates
from tidegate.streaming.ingest import start_bronze, start_silver, start_silver_single
from tidegate.streaming.runner import ONCE, run_for, timeout_seconds, trigger_of


def session(name: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _pace(config: RunConfig) -> tuple[dict, float | None]:
    """Trigger and job time in seconds; a run that drains its input once is not cut off."""
    if config.once:
        return ONCE, None
    return trigger_of(config.trigger_minutes), timeout_seconds(config.job_minutes)


def run_bronze(raw: DataFrame, config: RunConfig, summarize: bool = False, recent_minutes: float | None = None) -> float:
    """Land bus records for the job time; returns the seconds it ran."""
    trigger, seconds = _pace(config)
    return run_for(start_bronze(raw, config.layout, config.mode, trigger, summarize=summarize, recent_minutes=recent_minutes), seconds)


def run_silver(
    spark: SparkSession,
    config: RunConfig,
    templates: dict[str, Template],
    errors: dict[str, str] | None = None,
    single: bool = False,
) -> None:
    """Feed the silver datasets for the job time, then raise what went wrong.

    Assets whose template file is bad are reported at the end, after the others
    have run.
    """
    trigger, seconds = _pace(config)
    args = (
        spark,
        config.layout,
        templates,
        config.mode,
        trigger,
        config.max_files_per_trigger,
        config.max_bytes_per_trigger,
    )
    if single:
        run_for(start_silver_single(*args), seconds)
    else:
        start_silver(*args, rejects=True).wait(seconds)
    if errors:
        raise ValueError("; ".join(f"template {a}: {e}" for a, e in sorted(errors.items())))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidegate")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "silver", "reset", "compact"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of the lake")
        job.add_argument("--bronze-table", help="catalog name of the bronze table")
        job.add_argument("--silver-table", help="catalog name the silver tables start with")
        if name == "reset":
            job.add_argument("--layer", choices=("bronze", "silver"), required=True)
            job.add_argument("--yes", action="store_true", help="delete instead of listing")
            continue
        if name == "compact":
            job.add_argument("--layer", choices=("bronze", "silver"), required=True)
            job.add_argument("--goal", type=int, default=GOAL, help="bytes of a packed file")
            continue
        job.add_argument("--trigger", type=float, default=1, help="minutes between batches, 0 for none")
        job.add_argument("--minutes", type=float, default=15, help="job time, 0 for no end")
        job.add_argument("--mode", choices=("strict", "compat"), default="strict")
        job.add_argument("--once", action="store_true", help="take what is there, then end")
        job.add_argument("--max-files", type=int)
        job.add_argument("--max-bytes", type=int, default=100_000_000_000, help="input files of one batch")
        if name == "bronze":
            job.add_argument("--lookback", type=float, default=60, help="start this many minutes ago")
            source = job.add_mutually_exclusive_group(required=True)
            source.add_argument("--source", help="folder in which bus records land as Parquet")
            source.add_argument("--kafka", help="bootstrap servers")
            job.add_argument("--topic", help="needed with --kafka")
            job.add_argument("--max-offsets", type=int, default=100_000_000, help="Kafka records of one batch")
            job.add_argument("--end", help="take records enqueued up to this instant")
            job.add_argument("--archive", help="move files of --source here when they are done with")
            job.add_argument("--bus-columns", help="DDL of the bus columns in --source, '' for none; else those that have landed")
            job.add_argument("--summarize", action="store_true", help="keep sketches of devices and delays for each batch")
            job.add_argument("--recent", type=float, metavar="MINUTES", help="drop copies that follow within this time before the merge")
        else:
            job.add_argument("--templates", required=True, help="JSON file: asset name to template file")
            job.add_argument("--template-folder", default="")
            job.add_argument("--single", action="store_true", help="one stream for all templates")
    return parser


def main(argv: Sequence[str] | None = None) -> Reset | None:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "kafka", None) and not args.topic:
        parser.error("--kafka needs --topic")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session(f"tidegate-{args.job}")
    layout = Layout(args.root, args.bronze_table, args.silver_table)
    if args.job == "reset":
        reset = reset_layer(spark, layout, args.layer, dry_run=not args.yes)
        print(json.dumps({"tables": reset.tables, "paths": reset.paths, "dry_run": reset.dry_run}))
        return reset
    if args.job == "compact":
        done = compact_layer(spark, layout, args.layer, args.goal)
        print(json.dumps({name: vars(d) for name, d in done.items()}))
        return None
    config = RunConfig(
        layout,
        trigger_minutes=args.trigger,
        job_minutes=args.minutes,
        lookback_minutes=getattr(args, "lookback", 60),
        mode=args.mode,
        max_files_per_trigger=args.max_files,
        max_bytes_per_trigger=args.max_bytes,
        once=args.once,
    )
    if args.job == "bronze":
        start = first_start(spark, layout.start("bronze"), config.lookback_minutes)
        if args.kafka:
            begin = datetime.fromisoformat(start)
            options = kafka_options(args.kafka, args.topic, begin, max_offsets=args.max_offsets)
            raw = between_positions(kafka_stream(spark, options), end=args.end)
        else:
            raw = bus_stream(
                spark,
                args.source,
                start,
                args.end,
                config.max_files_per_trigger,
                config.max_bytes_per_trigger,
                schema=landing_schema(spark, args.source, args.bus_columns),
                archive=args.archive,
            )
        seconds = run_bronze(raw, config, args.summarize, args.recent)
        print(f"bronze ran {seconds / 60:.1f} minutes")
        return None
    listing = spark.read.option("wholetext", True).text(args.templates).first().value
    templates, errors = compile_templates(spark, json.loads(listing), args.template_folder)
    run_silver(spark, config, templates, errors, args.single)
    return None


if __name__ == "__main__":
    main()

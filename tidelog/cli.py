"""Command line: ``python -m tidelog --mode ...``."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace

from tidelog.config import Settings, spec_for
from tidelog.plans import jobs, reports, topics
from tidelog.session import build_session
from tidelog.plans.layers import advance_marks
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import MARKS, Lake
from tidelog.sources import read_change_log, read_jdbc, stream_change_log
from tidelog.sources.change_log import starting_offsets

# "trino" is kept as another name of "reports" for existing scripts.
MODES = ("kafka", "transform", "reports", "trino", "all", "streaming", "maintain", "seed")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidelog", description="Change-data-capture tables on Spark")
    p.add_argument("--mode", choices=MODES, required=True)
    p.add_argument("--topic", help="registered topic (default: KAFKA_TOPIC)")
    p.add_argument(
        "--topics",
        help="several registered topics, comma-separated, each with a lake of its own below the root "
        "(kafka, transform, streaming)",
    )
    p.add_argument("--consume-mode", choices=("batch", "streaming"), default="batch")
    p.epilog = "A stream takes 10,000 offsets a trigger unless TIDELOG_MAX_OFFSETS_PER_TRIGGER says more."
    p.add_argument("--checkpoint-dir", help="durable checkpoint folder (STREAMING_CHECKPOINT)")
    p.add_argument("--layer", choices=jobs.LAYERS, default="all")
    p.add_argument("--full", action="store_true", help="rebuild layers from the whole history")
    p.add_argument("--section", choices=sorted(reports.SECTIONS))
    p.add_argument("--root", help="folder of the layer tables (TIDELOG_ROOT)")
    p.add_argument("--buckets", type=int, help="key buckets of Silver")
    p.add_argument("--source-path", help="read the change log from files instead of Kafka")
    p.add_argument("--source-format", default="parquet")
    p.add_argument(
        "--dedupe",
        choices=jobs.DEDUPE,
        help="default: none on streams; batch: offsets on Kafka, exact on files",
    )
    p.add_argument("--seed-table", help="table that --mode seed fills")
    p.add_argument("--seed-key", help="its key columns, comma-separated")
    p.add_argument("--seed-query", help="query that runs at TIDELOG_JDBC_URL (or --source-path: files)")
    p.add_argument("--merge-every", type=int, default=1)
    p.add_argument(
        "--merge-share",
        type=float,
        default=0.0,
        help="merge once the waiting batches have this share of Silver's bytes",
    )
    p.add_argument(
        "--silver-parts",
        type=int,
        help="streaming: keep Silver by key in so many partitions, of which a merge touches only some",
    )
    p.add_argument("--replay-within", help="streaming: leave out copies within this span of log time, such as '2 hours'")
    p.add_argument("--metrics", action="store_true", help="streaming: count events by operation in the progress rows")
    p.add_argument("--available-now", action="store_true", help="drain the stream and stop")
    p.add_argument("--show-config", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    settings = Settings.from_env()
    settings = replace(
        settings,
        topic=args.topic or settings.topic,
        lake_root=args.root or settings.lake_root,
        checkpoint=args.checkpoint_dir or settings.checkpoint,
    )
    for name, value in settings.describe().items():
        print(f"{name:>24} : {value}")
    if args.show_config:
        return 0
    several = [t.strip() for t in (args.topics or "").split(",") if t.strip()]
    specs = [spec_for(topic) for topic in several]
    spec = specs[0] if specs else spec_for(settings.topic)
    if not settings.lake_root:
        raise SystemExit("set --root or TIDELOG_ROOT")

    spark = build_session(f"tidelog-{args.mode}")
    try:
        return _run_topics(args, settings, specs, spark) if specs else _run(args, settings, spec, spark)
    finally:
        spark.stop()


def _run(args, settings: Settings, spec, spark) -> int:
    lake = Lake(spark, settings.lake_root, spec, buckets=args.buckets)
    source = {"path": args.source_path, "file_format": args.source_format, "settings": settings}
    dedupe = args.dedupe or ("exact" if args.source_path else "offsets")

    def batch_log():
        starting = None
        if dedupe == "offsets" and not args.source_path:
            advance_marks(lake)
            starting = starting_offsets(lake.read(MARKS), spec.topic)
        return read_change_log(spark, spec, starting=starting, **source)

    if args.mode == "streaming":
        log = stream_change_log(spark, spec, **source)
        query = jobs.stream(
            log,
            lake,
            settings,
            available_now=args.available_now,
            merge_every=args.merge_every,
            merge_share=args.merge_share,
            dedupe=args.dedupe or "none",
            register=not args.silver_parts,
            table=_by_key(args, lake),
            replay_within=args.replay_within,
            metrics=args.metrics,
        )
        jobs.await_all([query])
    elif args.mode == "kafka" and args.consume_mode == "streaming":
        if not settings.checkpoint:
            raise SystemExit("set --checkpoint-dir or STREAMING_CHECKPOINT")
        log = stream_change_log(spark, spec, **source)
        trigger = None if args.available_now else settings.trigger_seconds
        jobs.await_all(jobs.stream_bronze([(log, lake)], settings.checkpoint, trigger))
    elif args.mode == "kafka":
        print(f"bronze: {jobs.ingest(batch_log(), lake, dedupe)} rows added")
        print(jobs.verify(lake))
    elif args.mode == "transform":
        print(jobs.transform(lake, args.layer, args.full))
        lake.register()
    elif args.mode == "all":
        print(jobs.run_all(batch_log, lake, dedupe))
    elif args.mode == "seed":
        if not args.seed_table or not args.seed_key:
            raise SystemExit("seed needs --seed-table and --seed-key")
        if args.source_path:
            rows = spark.read.format(args.source_format).load(args.source_path)
        elif args.seed_query:
            rows = read_jdbc(spark, args.seed_query, settings)
        else:
            raise SystemExit("seed needs --seed-query or --source-path")
        jobs.seed(spark, rows, args.seed_table, args.seed_key.split(","))
    elif args.mode == "maintain":
        print(jobs.maintain(lake))
    else:
        lake.register()
        reports.show(reports.run(spark, spec, args.section, lake.prefix))
    return 0


def _by_key(args, lake: Lake) -> KeyedTable | None:
    if not args.silver_parts:
        return None
    return KeyedTable(lake.spark, lake.folders.at("silver_by_key"), lake.spec, args.silver_parts)


def _run_topics(args, settings: Settings, specs, spark) -> int:
    """Several topics: one scan or stream for all, a lake for each."""
    root = settings.lake_root.rstrip("/")
    lakes = {spec.topic: Lake(spark, f"{root}/{spec.name}", spec, buckets=args.buckets) for spec in specs}
    source = {"path": args.source_path, "file_format": args.source_format, "settings": settings, "topics": list(lakes)}
    if args.mode == "streaming":
        if not settings.checkpoint:
            raise SystemExit("set --checkpoint-dir or STREAMING_CHECKPOINT")
        query = topics.start_topics(
            stream_change_log(spark, specs[0], **source),
            lakes,
            settings.checkpoint,
            f"{root}/dealt_out",
            tables={t: table for t, lake in lakes.items() if (table := _by_key(args, lake))},
            query_name=settings.query_name,
            trigger_seconds=None if args.available_now else settings.trigger_seconds,
            dedupe=args.dedupe or "none",
        )
        jobs.await_all([query])
    elif args.mode == "kafka" and args.consume_mode == "batch":
        # Stored offsets narrow the filter, not the scan: it starts at the earliest record of all topics.
        log = read_change_log(spark, specs[0], **source)
        print(topics.ingest_topics(log, lakes, args.dedupe or "exact"))
    elif args.mode == "transform":
        print(jobs.run_stages({t: lambda lake=lake: jobs.transform(lake, args.layer, args.full) for t, lake in lakes.items()}))
    else:
        raise SystemExit("--topics goes with kafka (batch), transform and streaming")
    return 0


if __name__ == "__main__":
    sys.exit(main())

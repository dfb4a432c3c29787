"""Command line: ``python -m tidemart <job> ...`` (also as a spark-submit script)."""

from __future__ import annotations

import argparse
import itertools
import logging
import random
import time

from pyspark.sql import Observation

from tidemart import reporting
from tidemart.operators.messages import topic_counts
from tidemart.plans import generator, jobs
from tidemart.session import build_session
from tidemart.sources import messages
from tidemart.sources.lake import Lake
from tidemart.streaming import pipeline
from tidemart.workspace import shared_root

log = logging.getLogger("tidemart")

# Continuous generation adds up what was sent every so many seconds, and reports after so many looks.
LOOK_SECONDS, REPORT_EVERY = 10, 6


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemart", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--lake", help="folder of the tables (default: <spark.checkpoint.dir>/lake)")
    common.add_argument("--shuffle-partitions", type=int, help="shuffled bytes / 128 MB")

    channel = argparse.ArgumentParser(add_help=False)
    where = channel.add_mutually_exclusive_group(required=True)
    where.add_argument("--bootstrap-servers", help="Kafka brokers (needs the Kafka connector)")
    where.add_argument("--landing", help="folder of message files")

    stream = commands.add_parser("stream", parents=[common, channel], help="messages to silver")
    stream.add_argument("--job-type", choices=pipeline.JOB_TYPES, default="both")
    stream.add_argument("--once", action="store_true", help="process what is there, then stop")
    stream.add_argument(
        "--starting-offsets", choices=("latest", "earliest"), default="latest",
        help="where a topic is read from at the very first start; with --once, latest finds nothing then",
    )
    stream.add_argument("--id-order", choices=("key_first", "payload_first"), default="key_first")
    stream.add_argument("--every", help="time between batches (default: 30 seconds, 1 minute)")
    stream.add_argument("--files-per-trigger", type=int, help="most files, or commits of raw events, in one batch")
    stream.add_argument("--single-query", action="store_true", help="one query for all silver tables")
    stream.add_argument(
        "--kafka-option", action="append", default=[], metavar="NAME=VALUE",
        help="reader option, e.g. maxOffsetsPerTrigger=50000000 or minPartitions=2000",
    )

    for job, plan in jobs.JOBS.items():
        gold = commands.add_parser(job, parents=[common], help=f"write {plan.table}")
        gold.add_argument(
            "--target_date", "--date", default="today", help="YYYY-MM-DD, today or yesterday"
        )
        gold.add_argument("--mode", choices=("replace", "dynamic"), default="replace")
        gold.add_argument("--show", action="store_true", help="print a few rows of the table")
        if job == "customer":
            gold.add_argument(
                "--user-only", action="store_true", help="join on the user alone: over n days up to n x n rows a user"
            )

    vacuum = commands.add_parser("vacuum", parents=[common], help="delete old versions of all tables")
    vacuum.add_argument("--keep", type=int, required=True, help="versions of each table that stay")

    seal = commands.add_parser("seal", parents=[common], help="rewrite days of silver, and raw events, into large files")
    seal.add_argument("--before", default="today", help="YYYY-MM-DD, today or yesterday: this day and later ones are left alone")

    generate = commands.add_parser("generate", parents=[common, channel], help="make events")
    generate.add_argument("--num-events", type=int, default=1000)
    generate.add_argument("--delay", type=float, default=0.1, help="seconds between events")
    generate.add_argument("--continuous", "-c", action="store_true")
    generate.add_argument("--topic", default="raw-events", help="topic of unknown event types")
    generate.add_argument("--seed", type=int, help="repeats the events of an earlier run (default: new events)")
    generate.add_argument("--first", type=int, default=0, help="number of the first event")
    generate.add_argument("--users", type=int, default=1000)
    generate.add_argument("--products", type=int, help="default: 5 to 15 for each type of item")
    generate.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE", help="writer option")
    return parser.parse_args(arguments)


def _stream(lake: Lake, options: argparse.Namespace) -> None:
    source = None
    if options.job_type != "processing":
        if options.bootstrap_servers:
            reader = messages.kafka_options(options.bootstrap_servers, starting=options.starting_offsets, **_pairs(options))
            source = messages.from_kafka(lake.spark, reader)
        else:
            source = messages.from_files(
                lake.spark, options.landing, max_files_per_trigger=options.files_per_trigger
            )
    choices = {"id_order": options.id_order, "files": options.files_per_trigger, "single": options.single_query}
    if options.once:
        pipeline.drain(lake, source, options.job_type, **choices)
    else:
        trigger = {"processingTime": options.every} if options.every else None
        queries = pipeline.start(lake, options.job_type, source, trigger=trigger, **choices)
        pipeline.run_until_stopped(lake.spark, queries)


def _gold(lake: Lake, options: argparse.Namespace) -> None:
    build = {"same_day": False} if getattr(options, "user_only", False) else {}
    record = jobs.run(lake, options.command, options.target_date, mode=options.mode, **build)
    log.info("%s", record)
    if options.show and record["status"] == reporting.SUCCESS:
        table = jobs.JOBS[options.command].table
        reporting.summarize(lake.read("gold", table), table)


def _vacuum(lake: Lake, options: argparse.Namespace) -> None:
    for plan in jobs.JOBS.values():
        log.info("%s: deleted %s", plan.table, lake.vacuum_gold(plan.table, options.keep) or "nothing")
    for layer, table in pipeline.TABLES:
        log.info("%s: deleted %s", table, lake.vacuum(layer, table, options.keep) or "nothing")


def _seal(lake: Lake, options: argparse.Namespace) -> None:
    day = jobs.target_day(options.before)
    for layer, table in pipeline.TABLES:
        found = lake.seal(layer, table, day if layer == "silver" else None)
        log.info("%s: sealed %s", table, found or "nothing")


def _pairs(options: argparse.Namespace) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options.kafka_option)


def _generate(lake: Lake, options: argparse.Namespace) -> None:
    spark = lake.spark
    seed = random.SystemRandom().getrandbits(31) if options.seed is None else options.seed
    log.info("seed %d", seed)
    shop = generator.Shop(seed=seed, users=options.users, products=options.products)
    if options.continuous:
        numbers = generator.unending(spark, options.delay, options.first)
    else:
        numbers = generator.numbered(spark, options.num_events, gap=options.delay, first=options.first)
    made = shop.messages(numbers, base_topic=options.topic)
    # Counted while they are sent; a stream reports the counts of each batch.
    sent = "sent" if options.continuous else Observation("sent")
    made = made.observe(sent, *topic_counts(options.topic))
    checkpoint = lake.checkpoint("generator")
    if options.bootstrap_servers:
        query = messages.to_kafka(made, options.bootstrap_servers, checkpoint, **_pairs(options))
    else:
        query = messages.to_files(made, options.landing, checkpoint=checkpoint)
    if query is None:
        log.info("topic distribution: %s", sent.get)
        return
    totals = _Totals(sent)
    # Looked at often: a query remembers only its latest batches.
    for look in itertools.count(1):
        if query.awaitTermination(LOOK_SECONDS):
            break
        totals.add(query.recentProgress)
        if look % REPORT_EVERY == 0:
            totals.report()
    totals.add(query.recentProgress)
    totals.report()


class _Totals:
    """Events sent since the start, by topic, from the counts of each batch."""

    def __init__(self, name: str):
        self.name, self.start, self.last, self.topics = name, time.monotonic(), -1, {}

    def add(self, batches) -> None:
        for batch in batches:
            counts = batch.observedMetrics.get(self.name)
            if batch.batchId > self.last and counts is not None:
                self.last = batch.batchId
                for topic, n in counts.asDict().items():
                    self.topics[topic] = self.topics.get(topic, 0) + (n or 0)

    def report(self) -> None:
        events, minutes = sum(self.topics.values()), (time.monotonic() - self.start) / 60
        log.info("%d events, %.1f events/min, topic distribution: %s", events, events / max(minutes, 1e-9), self.topics)


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    options = parse(arguments)
    spark = build_session(
        f"tidemart-{options.command}",
        kafka=bool(getattr(options, "bootstrap_servers", None)),
        shuffle_partitions=options.shuffle_partitions,
    )
    lake = Lake(spark, options.lake or f"{shared_root(spark)}/lake").create()
    if options.command == "stream":
        _stream(lake, options)
    elif options.command == "vacuum":
        _vacuum(lake, options)
    elif options.command == "seal":
        _seal(lake, options)
    elif options.command == "generate":
        _generate(lake, options)
    else:
        _gold(lake, options)


if __name__ == "__main__":
    main()

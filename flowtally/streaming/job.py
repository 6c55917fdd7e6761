"""Command line for the jobs of a deployment.

    spark-submit --packages <spark-sql-kafka> flowtally/streaming/job.py account \\
        --root hdfs://…/flowtally --run 2024a --brokers host1:9092,host2:9092

All tables lie below ``--root``: partials/, rejects/, rollups/, archive/, intake/ and
checkpoints/. A new checkpoint needs a new ``--run`` name.
"""

import argparse

from flowtally.functions.timekeys import DEFAULT_TZ
from flowtally.plans.base import KEYS
from flowtally.session import build_session
from flowtally.sources import archive, kafka
from flowtally.streaming import intake, partials, served


# Records per second and partition where nothing is said: a start on a backlog
# then works through it in bounded micro-batches.
DEFAULT_RATE = 10_000


def arguments(argv=None):
    parser = argparse.ArgumentParser(prog="flowtally")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, text):
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of all tables")
        sub.add_argument("--tz", default=DEFAULT_TZ, help="time zone of hour and day keys")
        return sub

    account = command("account", "account both topics continuously")
    keep = command("archive", "archive both topics continuously")
    both = command("intake", "account and archive both topics in one pass")
    for sub in (account, keep, both):
        sub.add_argument("--run", required=True, help="name of this checkpoint's life")
        sub.add_argument("--brokers", required=True)
        sub.add_argument("--seconds", type=int, default=300, help="micro-batch interval")
        sub.add_argument("--rate", type=int, default=DEFAULT_RATE,
                         help="most records per second and topic partition; 0 for no limit")
        sub.add_argument("--partitions", action="append", default=[], metavar="TOPIC=N",
                         help="partitions of a topic, 1 where not given; may be repeated")
    serve = command("serve", "keep the served tables of a feed up to date")
    serve.add_argument("--seconds", type=int, default=300, help="refresh interval")
    replay = command("replay", "account one archived day again, after a purge")
    replay.add_argument("--run", required=True, help="a name not used before")
    replay.add_argument("--max-bytes", type=int, default=4 * 2**30, help="archive bytes per micro-batch")
    purge = command("purge", "remove one day from partial sums and rollups")
    refresh = command("refresh", "rebuild rollups of some days, or of all")
    compact = command("compact", "merge the partial sums of each closed day into one part")
    compact.add_argument("--before", type=int, required=True, help="first day, yyyyMMdd, that is still open")
    for sub in (serve, replay, purge, refresh, compact):
        sub.add_argument("--feed", choices=sorted(KEYS), required=True)
    for sub in (replay, purge):
        sub.add_argument("--day", type=int, required=True, help="yyyyMMdd")
    refresh.add_argument("--day", type=int, action="append", help="yyyyMMdd, may be repeated")
    return parser.parse_args(argv)


def limit_of(args, topics):
    """Most records per micro-batch of a query that reads these topics, or None."""
    if not args.rate:
        return None
    counts = {name: int(n) for name, _, n in (p.partition("=") for p in args.partitions)}
    partitions = sum(counts.get(topic, 1) for topic in topics)
    return kafka.offsets_per_trigger(args.rate, partitions, args.seconds)


def main(argv=None, spark=None):
    args = arguments(argv)
    spark = spark or build_session(f"flowtally-{args.command}")
    if args.command in ("account", "archive", "intake"):
        def open_frame(*topics):
            return kafka.read_stream(
                spark, args.brokers, topics=topics, max_offsets=limit_of(args, topics))

        interval = {"processingTime": f"{args.seconds} seconds"}
        if args.command == "account":
            partials.start_feeds(open_frame, args.root, args.run, args.tz, **interval)
        elif args.command == "intake":
            intake.start(open_frame(*partials.TOPICS.values()), f"{args.root}/intake",
                         f"{args.root}/checkpoints/{args.run}/intake", args.run, args.tz, **interval)
        else:
            archive.write_stream(
                open_frame(*partials.TOPICS.values()), f"{args.root}/archive",
                f"{args.root}/checkpoints/{args.run}/archive", args.run,
                f"{args.root}/rejects/archive", args.tz, **interval)
        spark.streams.awaitAnyTermination()
        return
    sums, rollups = f"{args.root}/partials/{args.feed}", f"{args.root}/rollups/{args.feed}"
    if args.command == "serve":
        served.follow(spark, args.feed, sums, rollups, f"{args.root}/checkpoints/serve-{args.feed}",
                      processingTime=f"{args.seconds} seconds").awaitTermination()
    elif args.command == "replay":
        frame = archive.replay_stream(
            spark, f"{args.root}/archive", partials.TOPICS[args.feed], args.day,
            max_bytes=args.max_bytes)
        partials.start_partials(
            frame, args.feed, sums, f"{args.root}/checkpoints/{args.run}/{args.feed}", args.run,
            f"{args.root}/rejects/{args.feed}", args.tz, availableNow=True).awaitTermination()
        served.refresh(spark, args.feed, sums, rollups, [args.day])
    elif args.command == "compact":
        partials.compact(spark, args.feed, sums, partials.scattered_days(spark, sums, args.before))
    elif args.command == "purge":
        served.purge_partials(spark, args.feed, sums, args.day)
        served.purge_rollups(spark, args.feed, rollups, args.day)
    else:
        served.refresh(spark, args.feed, sums, rollups, args.day)


if __name__ == "__main__":
    main()

"""Command-line entry points for the streaming jobs (``spark-submit`` friendly).

    python -m txstream.jobs generate          --root R [--rows-per-second 10]
    python -m txstream.jobs log-to-topic      --root R [--partitions 4]
    python -m txstream.jobs process           --root R [--start earliest|latest]
    python -m txstream.jobs recovery-producer --root R [--rows-per-second 1]
    python -m txstream.jobs recovery-processor --root R [--start latest]
    python -m txstream.jobs load-test         --root R [--rows-per-second 1000]
                                              [--payload-size 100] [--parallelism 1]
    python -m txstream.jobs load-report       --root R     (batch: rates and p99 tables)

Every job keeps its own checkpoint under ``R/_checkpoints`` (or under
``--checkpoint-root``); ``--trigger``
sets the micro-batch interval (default 1 second), ``--available-now`` processes
what is there and stops, ``--max-records N`` stops a generator after N rows.
Each job only wires arguments to the library functions.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

if __package__ in (None, ""):        # run as a script: make the package importable
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession, functions as F

from txstream.plans import load, recovery
from txstream.plans.chain import COMPACT_EVERY, MAX_FILES, ChainPaths, log_stage, process_stage, topic_stage
from txstream.session import DEFAULT_CONF, checkpoint_root, ship_package
from txstream.sources.generators import generate_stream
from txstream.streaming.progress import ProgressLog


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="txstream.jobs")
    p.add_argument("job", choices=["generate", "log-to-topic", "process", "recovery-producer",
                                   "recovery-processor", "load-test", "load-report"])
    p.add_argument("--root", required=True, help="folder of the job's tables")
    p.add_argument("--checkpoint-root", help="folder for the chain's checkpoints")
    p.add_argument("--trigger", default="1 second")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--rows-per-second", type=int)
    p.add_argument("--max-records", type=int)
    p.add_argument("--partitions", type=int, default=4)
    p.add_argument("--parallelism", type=int, default=1)
    p.add_argument("--payload-size", type=int, default=100)
    p.add_argument("--start", choices=["earliest", "latest"], default="earliest")
    p.add_argument("--compact-every", type=int, default=COMPACT_EVERY)
    p.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES)
    p.add_argument("--max-bytes-per-trigger", help="for example 8g")
    p.add_argument("--max-offsets-per-trigger", type=int, help="bound of a broker's batch")
    p.add_argument("--log-name", default="transactions", help="the log's name on a broker")
    p.add_argument("--log-format", choices=["parquet", "kafka"], default="parquet")
    p.add_argument("--kafka-bootstrap-servers")
    return p


def _bounded(stream, max_records):
    # generated ids are 0, 1, 2, ...: keep the first ``max_records``
    if max_records is None:
        return stream
    key = "accountId" if "accountId" in stream.columns else "id"
    return stream.filter(F.col(key).cast("bigint") < max_records)


def writers(spark: SparkSession, args) -> list:
    root = args.root
    paths = ChainPaths.under(root)
    if args.checkpoint_root:
        paths.checkpoints = args.checkpoint_root
    paths.log_name = args.log_name
    files = {"max_files_per_trigger": args.max_files_per_trigger,
             "max_bytes_per_trigger": args.max_bytes_per_trigger}
    kafka = ({"kafka.bootstrap.servers": args.kafka_bootstrap_servers}
             if args.kafka_bootstrap_servers else None)
    if args.job == "generate":
        s = generate_stream(spark, "transactions", args.rows_per_second, args.parallelism)
        return [log_stage(_bounded(s, args.max_records), paths, args.log_format, kafka)]
    if args.job == "log-to-topic":
        return [topic_stage(spark, paths, args.partitions, args.log_format, kafka,
                            max_offsets_per_trigger=args.max_offsets_per_trigger, **files)]
    if args.job == "process":
        return [process_stage(spark, paths, start=args.start, num_partitions=args.partitions,
                              compact_every=args.compact_every, background=not args.available_now,
                              **files)]
    if args.job == "recovery-producer":
        s = generate_stream(spark, "sequence_events", args.rows_per_second, args.parallelism)
        return [recovery.producer(_bounded(s, args.max_records), root)]
    if args.job == "recovery-processor":
        return [recovery.processor(spark, root, start=args.start)]
    s = generate_stream(spark, "payload_events", args.rows_per_second, args.parallelism,
                        payload_size=args.payload_size)
    writer, reader = load.load_writers(spark, _bounded(s, args.max_records), root,
                                       args.parallelism)
    return [writer, reader()]


def load_report(spark: SparkSession, root: str, window: str | None = None,
                slide: str | None = None, window_seconds: int | None = None) -> None:
    """The load test's four dashboard figures, written as tables under ``root/report``:
    per-partition rate, total rate, p99 lag per partition and its average."""
    from txstream.operators import metrics
    window = window or metrics.RATE_WINDOW
    slide = slide or metrics.RATE_STEP
    window_seconds = window_seconds or metrics.RATE_WINDOW_SECONDS
    samples = load.read_samples(spark, root)
    out = f"{root}/report"
    metrics.rate_sliding(samples, "partition", "processed_at", window, slide, window_seconds) \
        .write.mode("overwrite").parquet(f"{out}/rate")
    metrics.rate_total(samples, "processed_at", window, slide, window_seconds) \
        .write.mode("overwrite").parquet(f"{out}/rate_total")
    metrics.lag_p99(samples, "partition", "processed_at").write.mode("overwrite") \
        .parquet(f"{out}/lag_p99")
    metrics.lag_p99_avg(samples, "partition", "processed_at").write.mode("overwrite") \
        .parquet(f"{out}/lag_p99_avg")


def run(spark: SparkSession, argv: list[str]) -> list:
    args = _parser().parse_args(argv)
    checkpoint_root(spark)
    ship_package(spark)
    if args.job == "load-report":
        load_report(spark, args.root)
        return []
    started, log = [], ProgressLog()
    spark.streams.addListener(log)
    for w in writers(spark, args):
        w = w.trigger(availableNow=True) if args.available_now \
            else w.trigger(processingTime=args.trigger)
        started.append(w.start())
        if args.available_now:          # stages of one job may depend on each other
            started[-1].awaitTermination()
    if not args.available_now:
        if args.max_records is not None:
            _stop_after(started[-1], args.max_records, started[:-1], log)
        else:
            spark.streams.awaitAnyTermination()
    spark.streams.removeListener(log)
    for q in started:
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return started


def _stop_after(q, n: int, others, log: ProgressLog, poll_s: float = 0.5) -> None:
    """Stop ``q`` and ``others`` once ``q`` has committed ``n`` source rows (by all its reports)."""
    while q.isActive and sum(p.numInputRows for p in log.so_far(q)) < n:
        time.sleep(poll_s)
    for other in (q, *others):
        other.stop()


def main() -> None:
    builder = SparkSession.builder.appName("txstream-jobs")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    run(builder.getOrCreate(), sys.argv[1:])


if __name__ == "__main__":
    main()

"""Command-line entry points (``python -m wardpulse ...`` or spark-submit).

    score      readings stream -> lake table, alert table/topic (+ rejects)
    aggregate  readings stream -> closed 5-minute / 1-hour window tables
    query      run one registered query over a table folder, write parquet

Streams read the raw Kafka topic when ``--brokers`` (or ``BROKERS``) is given,
otherwise parquet files appearing under ``--replay``.  Output and checkpoint
folders live under ``--out``, which should be on the shared file system.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from wardpulse.session import prepare
from wardpulse.schemas import RAW


def _readings(spark: SparkSession, args):
    from wardpulse.streaming.scoring import MAX_FILES, file_readings, kafka_readings
    if args.brokers:
        readings, _ = kafka_readings(spark, args.brokers, max_offsets=args.max_offsets)
        return readings
    return file_readings(spark, args.replay, RAW, args.max_files or MAX_FILES)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="wardpulse")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("score", "aggregate"):
        s = sub.add_parser(name)
        s.add_argument("--brokers", default=os.environ.get("BROKERS"))
        s.add_argument("--replay", help="folder of RAW parquet files (file stream)")
        s.add_argument("--out", required=True)
        s.add_argument("--max-offsets", type=int, default=None)
        s.add_argument("--max-files", type=int, default=None)
        s.add_argument("--once", action="store_true", help="availableNow trigger")
        if name == "score":
            s.add_argument("--dedup", action="store_true", help="drop redelivered messages")
            s.add_argument("--time-mode", choices=("event", "processing"), default="event")
        if name == "aggregate":
            s.add_argument("--duration", default="5 minutes")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    args = p.parse_args(argv)

    spark = prepare(SparkSession.builder.appName(f"wardpulse-{args.cmd}").getOrCreate())
    if args.cmd == "query":
        from wardpulse.plans.registry import load_all
        qs, _ = load_all()
        qs[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    if not args.brokers and not args.replay:
        p.error("give --brokers (or BROKERS) or --replay")
    if args.cmd == "score":
        if args.brokers:
            from wardpulse.streaming.scoring import run_scoring_kafka
            run_scoring_kafka(spark, args.brokers, args.out, args.max_offsets, args.once,
                              args.dedup, args.time_mode)
        else:
            from wardpulse.streaming.scoring import run_scoring
            run_scoring(spark, _readings(spark, args), args.out, available_now=args.once,
                        dedup=args.dedup, time_mode=args.time_mode)
    else:
        from wardpulse.streaming.aggregates import run_aggregates
        run_aggregates(spark, _readings(spark, args), args.out, duration=args.duration,
                       available_now=args.once)
    if not args.once:
        spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line: ``python -m tillroll SOURCE WAREHOUSE``, or this file given to spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll.plans.runner import run_pipeline
from tillroll.schemas import LOG_LAYERS
from tillroll.session import MAX_SCAN_TASKS, MAX_SHUFFLE_PARTITIONS, cluster_conf, folder_bytes
from tillroll.sources.audit import load_log
from tillroll.sources.warehouse import Warehouse

GIB = 1 << 30


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillroll", description="Load order sheets into the warehouse.")
    parser.add_argument("source", help="folder of order sheets")
    parser.add_argument("warehouse", help="root folder of the warehouse")
    parser.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside CSV cells; one task per file")
    parser.add_argument("--timestamp-format", help="pattern of invoice dates that are not ISO")
    parser.add_argument("--input-gb", type=float, help="size of the source, if not that of the folder")
    parser.add_argument("--cores", type=int, help="task slots of the cluster, if not those of the session")
    parser.add_argument("--max-scan-tasks", type=int, default=MAX_SCAN_TASKS)
    parser.add_argument("--max-shuffle-partitions", type=int, default=MAX_SHUFFLE_PARTITIONS)
    parser.add_argument("--skip-key-checks", action="store_true")
    parser.add_argument("--keep-snapshots", type=int, default=2, help="older snapshots are deleted; 0 keeps all")
    parser.add_argument("--take-over", action="store_true", help="end an open batch whose process died")
    parser.add_argument("--quarantine", action="store_true", help="set rows with bad cells aside instead of failing")
    parser.add_argument("--resume", action="store_true", help="go on with the last batch if it failed on the same files")
    args = parser.parse_args(argv)

    # A session of its own: the settings below are for this batch.
    spark = SparkSession.builder.appName("tillroll").getOrCreate().newSession()
    size = int(args.input_gb * GIB) if args.input_gb else folder_bytes(spark, args.source)
    cores = args.cores or spark.sparkContext.defaultParallelism
    conf = cluster_conf(size, cores, args.max_scan_tasks, args.max_shuffle_partitions)
    for key, value in conf.items():
        # What is fixed when the application starts is left to spark-submit.
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)

    batch = run_pipeline(
        spark,
        args.source,
        args.warehouse,
        fmt=args.format,
        multi_line=args.multi_line,
        timestamp_format=args.timestamp_format,
        verify_keys=not args.skip_key_checks,
        keep_snapshots=args.keep_snapshots or None,
        take_over=args.take_over,
        quarantine=args.quarantine,
        resume=args.resume,
    )
    events = Warehouse(spark, args.warehouse).log.events().filter(f"batch_id = '{batch.batch_id}'")
    for layer in LOG_LAYERS:
        load_log(events, layer).show(truncate=False)


if __name__ == "__main__":
    main()

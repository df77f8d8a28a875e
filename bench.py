"""Times the headline queries and one whole batch; prints one JSON line.

Each is run twice in one session and the better time counts, so that code generation and
just-in-time compilation weigh less.

``$BENCH_SF_DIR`` is the folder of the tables, ``$BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from checks.queries import QUERIES, _sheet
from tillroll.plans.runner import run_pipeline
from tillroll.session import local_session
from tillroll.sources.audit import stage_durations
from tillroll.sources.warehouse import Warehouse

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2
HEADLINE = (
    "raw_orders",
    "stg_orders_raw_clean",
    "stg_orders_valid",
    "rejected_rows",
    "dim_customer",
    "dim_product",
    "dim_date",
    "lookup_date_key",
    "lookup_product",
    "lookup_customer",
    "fact_sales",
    "top_n_per_group",
    "pk_violations",
    "fk_violations",
    "audit_latest",
)


def _timed_query(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def _timed_batch(spark: SparkSession, landing: str, root: str) -> dict[str, float]:
    start = time.perf_counter()
    run_pipeline(spark, landing, root, fmt="parquet")
    seconds = {"batch": round(time.perf_counter() - start, 3)}
    for row in stage_durations(Warehouse(spark, root).log.events()).collect():
        seconds[f"batch_{row['table']}"] = round(float(row["seconds"]), 3)
    return seconds


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.sql.shuffle.partitions": str(2 * int(CPUS))})
    # Starts executors and compiles common code, outside of any measured time.
    QUERIES["stg_orders_raw_clean"](spark, FOLDER).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        seconds[name] = min(_timed_query(spark, name) for _ in range(RUNS))

    # The batch from landed files to the published star schema, stage by stage.
    folder = tempfile.mkdtemp(prefix="bench-")
    _sheet(spark, FOLDER).write.parquet(f"{folder}/landing")
    batches = [_timed_batch(spark, f"{folder}/landing", f"{folder}/dwh-{i}") for i in range(RUNS)]
    seconds.update(min(batches, key=lambda b: b["batch"]))

    print(
        json.dumps(
            {
                "metric": "headline queries and one batch, total",
                "value": round(sum(seconds[n] for n in (*HEADLINE, "batch")), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

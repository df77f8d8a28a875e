"""One batch: source files to star schema, table by table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas
from tillroll.operators import fingerprint_checks, read_fingerprint, rename_columns
from tillroll.plans.dimensions import build_dim_customer, build_dim_date, build_dim_product
from tillroll.plans.fact import build_fact
from tillroll.plans.staging import build_clean, build_raw, build_valid, split_clean
from tillroll.schemas import Table
from tillroll.scratch import Scratch
from tillroll.session import require_session
from tillroll.sources.audit import FAILED, SUCCESS, loaded
from tillroll.sources.landing import read_landing
from tillroll.sources.warehouse import Warehouse


@dataclass
class Batch:
    batch_id: str
    row_counts: dict[str, int] = field(default_factory=dict)


def run_stages(
    warehouse: Warehouse,
    batch: Batch,
    builds: list[tuple[Table, Callable[[dict[str, DataFrame]], DataFrame]]],
    file_name: str | None = None,
    verify_keys: bool = True,
    proven_keys: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Load some tables, each from those before it, and publish all of them at once.

    On an error the stages are logged as failed, all of these tables keep their former rows, and
    the error goes on to the caller. ``proven_keys`` are foreign keys that the builds compare with
    their parents themselves. Returns the tables as written, by name.
    """
    begun: list[tuple[Table, dict]] = []
    written: dict[str, DataFrame] = {}
    try:
        for table, build in builds:
            begun.append((table, warehouse.log.start(table, batch.batch_id, file_name)))
            done = warehouse.load_snapshot(table, build(written), batch.batch_id)
            if verify_keys:
                warehouse.check_keys(table, batch.batch_id, done.row_count, proven_keys)
            # Its own end, though it is published with the others.
            begun[-1] = (table, loaded(begun[-1][1], done.row_count, done.fingerprint))
            written[table.name] = warehouse.read(table, batch.batch_id)
        warehouse.publish(begun)
    except Exception as error:
        warehouse.fail(begun, error)
        raise
    batch.row_counts.update({t.name: stage["row_count"] for t, stage in begun})
    return written


def _read_state(spark: SparkSession, folder: str, *how: object) -> str:
    """What a batch reads: names, sizes and times of the files, and how they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    state = files.agg(*(c.alias(n) for n, c in fingerprint_checks(files.columns).items())).first().asDict()
    return json.dumps([folder, *how, read_fingerprint(state, files.columns)])


def run_pipeline(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    fmt: str = "csv",
    multi_line: bool = False,
    timestamp_format: str | None = None,
    verify_keys: bool = True,
    keep_snapshots: int | None = 2,
    take_over: bool = False,
    quarantine: bool = False,
    resume: bool = False,
) -> Batch:
    """Load all tables of the warehouse at ``root`` from the order sheets at ``source``.

    ``source`` is a folder of files, or a DataFrame with the sheet's columns. Raw and staging
    tables are published one by one; the four business tables, which refer to each other, all at
    once and only after the fact is checked. ``verify_keys`` also checks primary and foreign
    keys, which the plans already ensure, by reading the written keys once more. Snapshots but
    for the ``keep_snapshots`` newest are deleted at the end (None keeps all). Only one batch
    may be open: ``take_over`` ends one whose process died. A cell that does not fit its type
    fails the batch; with ``quarantine``, its row goes to ``staging.stg_orders_refused`` instead,
    with all of its faults, published together with the clean table.

    ``resume`` goes on with the last batch, if that failed and has read the same files in the
    same way: its tables that are loaded are taken over, and only the others are built. If there
    is no such batch, a new one starts. It needs a folder, whose files can be compared.
    """
    require_session(spark)
    warehouse = Warehouse(spark, root)
    file_name = source if isinstance(source, str) else None
    if resume and file_name is None:
        raise ValueError("only a batch that reads a folder can be resumed")
    read = None if file_name is None else _read_state(spark, file_name, fmt, multi_line, timestamp_format, quarantine)
    failed = warehouse.log.failed_batch(read) if resume else None
    batch = Batch(failed or str(uuid.uuid4()))
    taken_over = warehouse.loaded(batch.batch_id) if failed else {}
    opened = warehouse.log.open_batch(batch.batch_id, take_over, read)
    scratch = Scratch(spark)

    def landed() -> DataFrame:
        if isinstance(source, DataFrame):
            return source
        return read_landing(spark, source, fmt, multi_line=multi_line)

    def stage(*builds, file_name: str | None = None, proven_keys: Collection[str] = ()) -> dict[str, DataFrame]:
        if all(table.name in taken_over for table, _ in builds):
            batch.row_counts.update({table.name: taken_over[table.name] for table, _ in builds})
            return {table.name: warehouse.read(table, batch.batch_id) for table, _ in builds}
        return run_stages(warehouse, batch, list(builds), file_name, verify_keys, proven_keys)

    try:
        raw = stage((schemas.RAW_ORDERS, lambda _: build_raw(rename_columns(landed()))), file_name=file_name)
        if quarantine:
            parts: list[DataFrame] = []

            def taken(_: dict[str, DataFrame]) -> DataFrame:
                parts.extend(split_clean(raw["raw_orders"], scratch, timestamp_format))
                return parts[0]

            clean = stage((schemas.ORDERS_CLEAN, taken), (schemas.ORDERS_REFUSED, lambda _: parts[1]))
        else:
            clean = stage((schemas.ORDERS_CLEAN, lambda _: build_clean(raw["raw_orders"], timestamp_format)))
        valid = stage((schemas.ORDERS_VALID, lambda _: build_valid(clean["stg_orders_raw_clean"])))
        lines = valid["stg_orders_valid"]
        stage(
            (schemas.DIM_CUSTOMER, lambda _: build_dim_customer(lines)),
            (schemas.DIM_PRODUCT, lambda _: build_dim_product(lines)),
            (schemas.DIM_DATE, lambda _: build_dim_date(lines, scratch)),
            (
                schemas.FACT_SALES,
                lambda done: build_fact(lines, done["dim_date"], done["dim_product"], done["dim_customer"], scratch),
            ),
            # The fact's plan has taken out what is unknown to the written dimensions.
            proven_keys=[fk.column for fk in schemas.FACT_SALES.foreign_keys],
        )
    except Exception as error:
        warehouse.log.finish(opened, FAILED, error_message=str(error))
        if fmt == "csv" and file_name and not multi_line and "MALFORMED" in str(error):
            hint = "a CSV row has too few or too many cells; if cells hold line breaks, read with multi_line"
            raise ValueError(hint) from error
        raise
    finally:
        scratch.clear()
    warehouse.log.finish(opened, SUCCESS)
    if keep_snapshots:
        warehouse.drop_old_snapshots(keep_snapshots)
    return batch

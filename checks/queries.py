"""One query per operator over the given tables, each ``(spark, folder) -> DataFrame``.

Load times and batch ids are left out of the results: they differ from run to run.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from unittest import mock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.order_lines import order_lines
from tillroll import operators, plans, schemas
from tillroll.functions import DATE_PARTS, return_flag, total_amount
from tillroll.plans import runner
from tillroll.plans.runner import run_pipeline
from tillroll.scratch import Scratch, list_files
from tillroll.sources import audit
from tillroll.sources.buckets import dimension_buckets, line_buckets
from tillroll.sources.landing import read_landing, write_landing
from tillroll.sources.warehouse import ConstraintError, Warehouse

KEYS = schemas.DEDUPE_KEYS
ORDER = schemas.ORDER_COLUMNS


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return plans.build_raw(order_lines(spark, folder))


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return plans.build_clean(_raw(spark, folder))


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return plans.build_valid(_clean(spark, folder))


def _stored_valid(spark: SparkSession, folder: str) -> tuple[DataFrame, Scratch]:
    """Valid rows written once, for queries that read them several times."""
    scratch = Scratch(spark)
    return scratch.cut(_valid(spark, folder), "valid"), scratch


def _sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines under the headers of the sheet, columns in another order."""
    headers = {name: header for header, name in schemas.SHEET_HEADERS.items()}
    lines = order_lines(spark, folder)
    return lines.select(*(F.col(c).alias(headers[c]) for c in sorted(ORDER, reverse=True)))


# -- sources and sinks -----------------------------------------------------------------------


def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    return operators.rename_columns(_sheet(spark, folder))


def normalize_nulls(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    cells = _table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("invoice_no"),
        F.when(priority == "4-NOT SPECIFIED", "N/A").otherwise(priority).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "NA")
        .when(F.col("o_orderstatus") == "O", "  ")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
    )
    return operators.normalize_nulls(cells)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    # Awkward cells: an empty text, and one with separator, quotes and a line break.
    description = F.col("description")
    awkward = (
        F.when(description.isNull(), "")
        .when(F.col("stock_code").isNull(), F.concat(description, F.lit(', "new"\nline')))
        .otherwise(description)
    )
    path = Scratch(spark).new_path("landing")
    write_landing(order_lines(spark, folder).withColumn("description", awkward), path)
    return read_landing(spark, path, multi_line=True)


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Scratch(spark).new_path("landing")
    _sheet(spark, folder).write.json(path, ignoreNullFields=False)
    return operators.rename_columns(read_landing(spark, path, "json"))


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Scratch(spark).new_path("landing")
    _sheet(spark, folder).write.parquet(path)
    return operators.rename_columns(read_landing(spark, path, "parquet"))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return plans.build_raw(operators.rename_columns(_sheet(spark, folder)))


def write_table(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    warehouse.write_snapshot(schemas.ORDERS_CLEAN, _clean(spark, folder), "batch")
    return warehouse.read(schemas.ORDERS_CLEAN, "batch").select(*ORDER)


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts as the load log of a whole batch has them."""
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    run_pipeline(spark, _sheet(spark, folder), warehouse.root)
    states = audit.audit_latest(audit.stage_events(warehouse.log.events()))
    return states.select("layer", F.col("table").alias("table_name"), "status", "row_count")


# -- cleaning --------------------------------------------------------------------------------


def standardize_text(spark: SparkSession, folder: str) -> DataFrame:
    return operators.standardize_text(_raw(spark, folder))


def cast_strict(spark: SparkSession, folder: str) -> DataFrame:
    return operators.cast_strict(_raw(spark, folder), schemas.TYPED_COLUMNS)


def required_keys(spark: SparkSession, folder: str) -> DataFrame:
    return operators.required_keys(_clean(spark, folder))


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    return operators.rejected_rows(_clean(spark, folder))


def with_return_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(*ORDER, return_flag().alias("return_flag"))


def with_total_amount(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(*ORDER, total_amount().alias("total_amount"))


def apply_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Defaults over all rows: one load time, no flag missing."""
    flagged = _clean(spark, folder).select(
        *ORDER, F.when(return_flag(), True).alias("return_flag")
    )
    return operators.apply_defaults(flagged).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ingestion_ts").alias("n_stamped"),
        F.count_distinct("ingestion_ts").alias("n_load_times"),
        F.count_if("return_flag").alias("n_returns"),
        F.count_if(~F.col("return_flag")).alias("n_sales"),
    )


def returns_only(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).filter(F.col("invoice_no").like("C%"))


def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.withColumns({name: part("l_shipdate") for name, part in DATE_PARTS.items()})


# -- grouping and ranking --------------------------------------------------------------------


def top_n_beyond_the_early_cut(spark: SparkSession, folder: str) -> DataFrame:
    """The 5,000 dearest lines of each country, one of which holds a third of them."""
    valid = _valid(spark, folder).filter(F.col("unit_price").isNotNull())
    hot = F.when(F.col("quantity") % 3 == 0, "HOT").otherwise(F.col("country"))
    order = [F.desc("unit_price"), *(F.asc_nulls_last(k) for k in KEYS)]
    ranked = operators.top_n_per_group(valid.withColumn("country", hot), ["country"], order, 5_000, "position")
    return ranked.select("country", "position", "invoice_no", "stock_code", "unit_price")


def top_n_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """The three dearest lines of each customer."""
    order = [F.desc("unit_price"), *(F.asc_nulls_last(k) for k in KEYS)]
    ranked = operators.top_n_per_group(_valid(spark, folder), ["customer_id"], order, 3, "position")
    return ranked.select("customer_id", "position", "invoice_no", "stock_code", "unit_price")


# -- star schema -----------------------------------------------------------------------------


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return plans.build_dim_date(_valid(spark, folder), Scratch(spark))


def lookup_date_key(spark: SparkSession, folder: str) -> DataFrame:
    valid, scratch = _stored_valid(spark, folder)
    dates = plans.build_dim_date(valid, scratch)
    return plans.lookup_date_key(valid, dates).select(*ORDER, "invoice_date_id")


def lookup_product(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the products that have a description."""
    valid, scratch = _stored_valid(spark, folder)
    described = plans.build_dim_product(valid).filter(F.col("description").isNotNull())
    return plans.lookup_product(valid, described, scratch).select(*ORDER)


def lookup_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the customers that are not mainly French."""
    valid, scratch = _stored_valid(spark, folder)
    others = plans.build_dim_customer(valid).filter(F.col("country") != "FRANCE")
    return plans.lookup_customer(valid, others, scratch).select(*ORDER)


def lookup(spark: SparkSession, folder: str) -> DataFrame:
    valid, _ = _stored_valid(spark, folder)
    products = plans.build_dim_product(valid).withColumnRenamed("description", "product")
    return operators.lookup(valid, products, "stock_code", ["product"]).select(*ORDER, "product")


def published_star(spark: SparkSession, folder: str) -> DataFrame:
    """The published fact with its dimensions after a second batch that fails at the fact.

    The second sheet holds an earlier date, which would shift every date key, and a line without
    a quantity, which the fact refuses.
    """
    warehouse = _failed_second_batch(spark, folder)
    fact = warehouse.read(schemas.FACT_SALES)
    date = warehouse.read(schemas.DIM_DATE).select("invoice_date_id", "invoice_date")
    product = warehouse.read(schemas.DIM_PRODUCT).select("stock_code", F.col("description").alias("product"))
    customer = warehouse.read(schemas.DIM_CUSTOMER).select("customer_id", F.col("country").alias("main_country"))
    # Narrow columns first: whatever a join adds is shuffled by the ones after it.
    star = fact.join(date, "invoice_date_id").join(customer, "customer_id").join(product, "stock_code")
    return star.select(
        "fact_id", "invoice_no", "stock_code", "customer_id", "invoice_date", "quantity", "unit_price",
        "total_amount", "return_flag", "product", "main_country",
    )


def _failed_second_batch(spark: SparkSession, folder: str) -> Warehouse:
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    sheet = _sheet(spark, folder)
    run_pipeline(spark, sheet, warehouse.root)
    planted = {"InvoiceNo": "0", "StockCode": "X", "CustomerID": "1", "InvoiceDate": "1900-01-01 00:00:00"}
    # One row of its own: taken from the sheet, it would cost the joins of the sheet once more.
    bad = spark.range(1).select(*(F.lit(planted.get(c)).cast("string").alias(c) for c in sheet.columns))
    try:
        run_pipeline(spark, sheet.unionByName(bad), warehouse.root)
    except ConstraintError:
        return warehouse
    raise AssertionError("a line without quantity was taken")


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    valid, scratch = _stored_valid(spark, folder)
    return plans.build_fact(
        valid,
        scratch.cut(plans.build_dim_date(valid, scratch), "dim_date"),
        scratch.cut(plans.build_dim_product(valid), "dim_product"),
        scratch.cut(plans.build_dim_customer(valid), "dim_customer"),
        scratch,
    )


def colocated_star(spark: SparkSession, folder: str) -> DataFrame:
    """The fact without its number, joined from buckets."""
    valid, scratch = _stored_valid(spark, folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Descriptions and countries are not moved: the fact takes none.
    lines = line_buckets(valid.select(*plans.LINE_COLUMNS), "customer_id", ["invoice_no", "stock_code"], buckets, scratch.new_path("lines"))
    customers = dimension_buckets(plans.build_dim_customer(valid), "customer_id", buckets, scratch.new_path("customers"))
    dates = scratch.cut(plans.build_dim_date(valid, scratch), "dim_date")
    products = scratch.cut(plans.build_dim_product(valid), "dim_product")
    return plans.build_colocated_fact(lines, dates, products, customers, scratch)


def stable_date_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Date keys after a batch of the later lines, and then one of all lines, which brings
    earlier dates."""
    valid, scratch = _stored_valid(spark, folder)
    later = valid.filter(F.col("invoice_date") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    first = scratch.cut(plans.build_dim_date(later, scratch), "dim_date")
    return plans.extend_dim_date(first, valid, scratch)


def catalog_star(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by country and year, by table names: of the first batch, pinned, and of the current
    one, whose prices are a cent higher."""
    mark = uuid.uuid4().hex[:8]
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"), f"t{mark}_")
    sheet = _sheet(spark, folder)
    first = run_pipeline(spark, sheet, warehouse.root)
    warehouse.pin(first.batch_id, f"pinned_{mark}")
    raised = (F.col("UnitPrice").cast("decimal(12,3)") + F.lit("0.01").cast("decimal(3,2)")).cast("string")
    run_pipeline(spark, sheet.withColumn("UnitPrice", raised), warehouse.root)
    warehouse.create_layers()
    totals = """
        SELECT '{state}' AS state, c.country, d.year, count(*) AS n_lines,
               CAST(sum(f.unit_price) AS decimal(18,2)) AS prices
        FROM {at}.fact_sales f JOIN {at}.dim_customer c USING (customer_id) JOIN {at}.dim_date d USING (invoice_date_id)
        GROUP BY c.country, d.year"""
    now, then = f"t{mark}_business", f"pinned_{mark}"
    return spark.sql(totals.format(state="now", at=now) + " UNION ALL " + totals.format(state="then", at=then))


# -- constraints -----------------------------------------------------------------------------


def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return operators.pk_violations(
        _table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def fk_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of products that a catalogue without promotional parts does not have."""
    catalogue = _table(spark, folder, "part").filter(F.col("p_type") != "PROMO")
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return operators.fk_violations(lines, catalogue, {"l_partkey": "p_partkey"})


def null_violations(spark: SparkSession, folder: str) -> DataFrame:
    return operators.null_violations(_clean(spark, folder), schemas.REQUIRED_KEYS)


def length_violations(spark: SparkSession, folder: str) -> DataFrame:
    return operators.length_violations(_clean(spark, folder), {"description": 12})


def range_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(12,2)") * 10_000).cast("decimal(18,2)").alias("amount"),
    )
    return operators.range_violations(lines, {"amount": "decimal(10,2)"})


def bad_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that are no full timestamps, planted among order dates."""
    key = F.col("o_orderkey")
    date = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    planted = ["40513", "101201", "2010", "2010-12", "2010-12-01 08:26:00+05:00", "2010-13-01", "12/1/2010 8:26", None]
    cell = F.when(key % 3 == 0, F.element_at(F.array(*(F.lit(x) for x in planted)), (key % len(planted) + 1).cast("int")))
    cell = cell.otherwise(F.when(key % 3 == 1, date).otherwise(F.concat(date, F.lit(" 08:26:00"))))
    cells = _table(spark, folder, "orders").select("o_orderkey", cell.alias("invoice_date"))
    return operators.bad_timestamps(cells, "invoice_date")


# Cells planted among lines, some of which do not fit the type of their column.
PLANTED = {
    "quantity": ["12", "1.0", "x7", "99999999999", " 8 ", None, ""],
    "invoice_date": [
        "2010-12-01", "40513", "2010-12", "2010-13-01", "2010-12-01 25:00:00", "2010-12-01 08:26:00+05:00", None,
        "2010-12-01 08:26:00", "2010-12-01T08:26",
    ],
    "unit_price": ["2.50", "1.005", "12,5", "100000000", "1e3"],
    "customer_id": ["7", "12a", "-2147483649", None],
}


def _split_planted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    for n, (column, cells) in enumerate(PLANTED.items()):
        place = (F.col("l_orderkey") * (n + 3) + F.col("l_linenumber")) % len(cells)
        lines = lines.withColumn(column, F.element_at(F.array(*(F.lit(c) for c in cells)), (place + 1).cast("int")))
    return operators.split_casts(lines, schemas.TYPED_COLUMNS, Scratch(spark))


def rejected_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with cells that do not fit, with every such cell and why."""
    _, refused = _split_planted(spark, folder)
    each = F.transform("faults", lambda x: F.concat_ws(": ", x["column"], x["value"], x["reason"]))
    return refused.withColumn("faults", F.array_join(each, "; "))


def accepted_casts(spark: SparkSession, folder: str) -> DataFrame:
    taken, _ = _split_planted(spark, folder)
    return taken


def quarantined_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of a batch that sets bad rows aside: prices of one customer in seven are no numbers."""
    sheet = _sheet(spark, folder)
    bad = F.coalesce(F.col("CustomerID").cast("int") % 7 == 0, F.lit(False))
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    run_pipeline(spark, sheet.withColumn("UnitPrice", F.when(bad, "n. a.").otherwise(F.col("UnitPrice"))), warehouse.root, quarantine=True)
    states = audit.audit_latest(audit.stage_events(warehouse.log.events()))
    return states.select("layer", F.col("table").alias("table_name"), "status", "row_count")


# -- audit -----------------------------------------------------------------------------------


def _log_after_failure(layer: str) -> Callable[[SparkSession, str], DataFrame]:
    """The log of a layer after a batch and a second one that fails at the fact."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        log = audit.load_log(_failed_second_batch(spark, folder).log.events(), layer)
        named = F.lit("raw_orders") if layer == "raw" else F.col("table")
        refused = F.coalesce(F.col("error_message").contains("quantity NOT NULL"), F.lit(False))
        return log.select(named.alias("table_name"), "status", "row_count", refused.alias("refused"))

    return query


def _load_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table read as stage events: users are batches, event types are tables."""
    event_id = F.col("event_id")
    status = (
        F.when(event_id % 4 == 0, audit.STARTED)
        .when(event_id % 4 == 3, audit.FAILED)
        .otherwise(audit.SUCCESS)
    )
    ended = F.col("status") != audit.STARTED
    run_time = F.make_dt_interval(secs=(event_id % 600_000).cast("decimal(12,0)") / 1000)
    events = _table(spark, folder, "events").withColumn("status", status)
    return events.select(
        event_id.alias("seq"),
        F.element_at(F.array(*(F.lit(x) for x in ("raw", "staging", "business"))),
                     (event_id % 3 + 1).cast("int")).alias("layer"),
        F.col("user_id").cast("string").alias("batch_id"),
        F.col("event_type").alias("table"),
        "status",
        F.when(F.col("status") == audit.SUCCESS, event_id * 10).alias("row_count"),
        F.col("ts").cast("timestamp_ntz").alias("started_at"),
        F.when(ended, F.col("ts").cast("timestamp_ntz") + run_time).alias("finished_at"),
        F.when(F.col("status") == audit.FAILED, "no reply").alias("error_message"),
    )


def audit_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = audit.audit_latest(_load_events(spark, folder))
    return latest.withColumnRenamed("table", "table_name")


def batch_durations(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of a real batch: none ends before it starts or starts before the one before has
    ended, and together they take no longer than the batch."""
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    run_pipeline(spark, _sheet(spark, folder), warehouse.root)
    states = audit.audit_latest(audit.stage_events(warehouse.log.events()))
    before = F.lag("finished_at").over(Window.orderBy("started_at"))  # seven rows
    took = audit.stage_durations(warehouse.log.events()).select("layer", "table", "seconds")
    whole = audit.audit_latest(warehouse.log.events().filter(F.col("table") == audit.BATCH_TABLE))
    batch_seconds = whole.select((F.col("finished_at") - F.col("started_at")).cast("interval second").cast("decimal(18,6)").alias("batch"))
    fits = took.agg(F.sum("seconds").alias("sum")).join(batch_seconds, F.col("sum") <= F.col("batch")).count() == 1
    spans = states.withColumn("in_turn", F.coalesce(F.col("started_at") >= before, F.lit(True)))
    return spans.join(took, ["layer", "table"]).select(
        "layer", F.col("table").alias("table_name"), (F.col("seconds") > 0).alias("took_time"), "in_turn", F.lit(fits).alias("fits_batch")
    )


def rerun_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches over the same lines, the second dealt anew: which columns of which tables differ."""
    scratch = Scratch(spark)
    warehouse = Warehouse(spark, scratch.new_path("warehouse"))
    # Stored, so that what its joins shuffle is gone before all of its cells are shuffled.
    sheet = scratch.cut(_sheet(spark, folder), "sheet")
    run_pipeline(spark, sheet, warehouse.root)
    run_pipeline(spark, sheet.repartition(*sheet.columns), warehouse.root)
    return _differences(warehouse)


def changed_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """The same, but the second sheet has every price raised by a cent."""
    warehouse = Warehouse(spark, Scratch(spark).new_path("warehouse"))
    sheet = _sheet(spark, folder)
    run_pipeline(spark, sheet, warehouse.root)
    raised = (F.col("UnitPrice").cast("decimal(12,3)") + F.lit("0.01").cast("decimal(3,2)")).cast("string")
    run_pipeline(spark, sheet.withColumn("UnitPrice", raised), warehouse.root)
    return _differences(warehouse)


def _differences(warehouse: Warehouse) -> DataFrame:
    found = audit.rerun_differences(warehouse.log.events())
    return found.select("layer", F.col("table").alias("table_name"), "row_count_before", "row_count", F.array_join("changed", ",").alias("changed"))


def resumed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """States and number of starts of all tables after a batch whose fact was lost, and was resumed."""
    scratch = Scratch(spark)
    warehouse, landing = Warehouse(spark, scratch.new_path("warehouse")), scratch.new_path("landing")
    _sheet(spark, folder).write.parquet(landing)
    with mock.patch.object(runner, "build_fact", side_effect=RuntimeError("lost")), contextlib.suppress(RuntimeError):
        run_pipeline(spark, landing, warehouse.root, fmt="parquet")
    run_pipeline(spark, landing, warehouse.root, fmt="parquet", resume=True)
    events = audit.stage_events(warehouse.log.events())
    starts = events.filter(F.col("status") == audit.STARTED).groupBy("layer", "table").agg(F.count(F.lit(1)).alias("n_starts"))
    states = audit.audit_latest(events).join(starts, ["layer", "table"])
    return states.select("layer", F.col("table").alias("table_name"), "status", "row_count", "n_starts")


def compacted_log(spark: SparkSession, folder: str) -> DataFrame:
    """Current states from a log of many files, after these have been put into one."""
    log = audit.AuditLog(spark, Scratch(spark).new_path("log"))
    events = _load_events(spark, folder)
    columns = [c.name for c in schemas.LOAD_EVENTS.columns]
    filled = events.select(*(F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in columns))
    filled.repartition(60, "seq").write.parquet(log.path)
    log.compact()
    n_files = len(list_files(spark, log.path, ".parquet"))
    latest = audit.audit_latest(log.events()).drop("file_name", "fingerprint")
    return latest.withColumnRenamed("table", "table_name").withColumn("n_files", F.lit(n_files))


def stage_durations(spark: SparkSession, folder: str) -> DataFrame:
    durations = audit.stage_durations(_load_events(spark, folder))
    return durations.withColumnRenamed("table", "table_name")


def _over_valid(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(_valid(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rename_columns": rename_columns,
    "normalize_nulls": normalize_nulls,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "raw_orders": raw_orders,
    "write_table": write_table,
    "row_counts": row_counts,
    "standardize_text": standardize_text,
    "cast_strict": cast_strict,
    "stg_orders_raw_clean": _clean,
    "required_keys": required_keys,
    "rejected_rows": rejected_rows,
    "return_flag": with_return_flag,
    "total_amount": with_total_amount,
    "apply_defaults": apply_defaults,
    "returns_only": returns_only,
    "date_parts": date_parts,
    "stg_orders_valid": _valid,
    "country_counts": _over_valid(plans.country_counts),
    "customer_main_country": _over_valid(plans.customer_main_country),
    "customer_invoice_span": _over_valid(plans.customer_invoice_span),
    "description_counts": _over_valid(plans.description_counts),
    "distinct_dates": _over_valid(plans.distinct_dates),
    "top_n_per_group": top_n_per_group,
    "top_n_beyond_the_early_cut": top_n_beyond_the_early_cut,
    "dim_customer": _over_valid(plans.build_dim_customer),
    "dim_product": _over_valid(plans.build_dim_product),
    "dim_date": dim_date,
    "lookup_date_key": lookup_date_key,
    "lookup": lookup,
    "lookup_product": lookup_product,
    "lookup_customer": lookup_customer,
    "fact_sales": fact_sales,
    "published_star": published_star,
    "colocated_star": colocated_star,
    "stable_date_keys": stable_date_keys,
    "catalog_star": catalog_star,
    "compacted_log": compacted_log,
    "resumed_batch": resumed_batch,
    "pk_violations": pk_violations,
    "fk_violations": fk_violations,
    "null_violations": null_violations,
    "length_violations": length_violations,
    "range_violations": range_violations,
    "bad_timestamps": bad_timestamps,
    "rejected_casts": rejected_casts,
    "accepted_casts": accepted_casts,
    "quarantined_batch": quarantined_batch,
    "batch_durations": batch_durations,
    "rerun_fingerprint": rerun_fingerprint,
    "changed_fingerprint": changed_fingerprint,
    "audit_latest": audit_latest,
    "stage_durations": stage_durations,
    "raw_load_log": _log_after_failure("raw"),
    "staging_load_log": _log_after_failure("staging"),
    "business_load_log": _log_after_failure("business"),
}

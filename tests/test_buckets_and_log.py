"""Joins from buckets, keys that stay, tables by name, and the log put together."""

import datetime

import pytest
from pyspark.sql import DataFrameWriter

from tests.conftest import at, rows
from tests.test_batch import SHEET
from tillroll import operators, plans, schemas
from tillroll.plans import runner
from tillroll.plans.runner import run_pipeline
from tillroll.scratch import list_files
from tillroll.sources import audit
from tillroll.sources.buckets import dimension_buckets, line_buckets
from tillroll.sources.warehouse import Warehouse


def many_lines(lines):
    return lines(*({"invoice_no": str(n), "customer_id": 7 if n % 3 else n, "stock_code": f"S{n % 5}", "invoice_date": at(1 + n % 9)} for n in range(60)))


def test_no_line_is_shuffled_for_the_star(spark, lines, scratch):
    valid = scratch.cut(many_lines(lines), "valid")
    customers = plans.build_dim_customer(valid)
    dates = scratch.cut(plans.build_dim_date(valid, scratch), "dates")
    products = scratch.cut(plans.build_dim_product(valid), "products")
    stored = line_buckets(valid, "customer_id", ["invoice_no"], 4, scratch.new_path("lines"))
    fact = plans.build_colocated_fact(stored, dates, products, dimension_buckets(customers, "customer_id", 4, scratch.new_path("customers")), scratch)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    plain = plans.build_fact(valid, dates, products, scratch.cut(customers, "customers"), scratch)
    assert rows(fact) == rows(plain.drop("fact_id"))
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("buckets_") for t in spark.catalog.listTables())


def test_a_hot_customer_is_in_several_buckets(spark, lines, scratch):
    hot = lines(*({"invoice_no": str(n), "customer_id": 7} for n in range(200)))
    path = scratch.new_path("lines")
    stored = line_buckets(hot, "customer_id", ["invoice_no"], 8, path)
    sizes = [spark.read.parquet(f).count() for f in list_files(spark, path, ".parquet")]
    assert sum(sizes) == 200 == stored.count()
    assert max(sizes) < 200


def test_unknown_customers_drop_out(spark, lines, scratch):
    valid = scratch.cut(many_lines(lines), "valid")
    some = plans.build_dim_customer(valid).filter("customer_id = 7")
    stored = line_buckets(valid, "customer_id", ["invoice_no"], 4, scratch.new_path("lines"))
    dates = scratch.cut(plans.build_dim_date(valid, scratch), "dates")
    products = scratch.cut(plans.build_dim_product(valid), "products")
    fact = plans.build_colocated_fact(stored, dates, products, dimension_buckets(some, "customer_id", 4, scratch.new_path("customers")), scratch)
    assert fact.count() == valid.filter("customer_id = 7").count()


def test_known_dates_keep_their_keys(spark, lines, scratch):
    first = scratch.cut(plans.build_dim_date(lines({"invoice_date": at(5)}, {"invoice_date": at(9)}, {"invoice_date": None}), scratch), "first")
    both = scratch.cut(plans.extend_dim_date(first, lines({"invoice_date": at(1)}, {"invoice_date": at(9)}, {"invoice_date": at(7)}, {"invoice_date": None}), scratch), "both")
    assert {r.invoice_date: r.invoice_date_id for r in both.collect()} == {at(5): 1, at(9): 2, None: 3, at(1): 4, at(7): 5}
    assert rows(plans.extend_dim_date(both, lines({"invoice_date": at(5)}), scratch)) == rows(both)
    assert rows(plans.extend_dim_date(first.limit(0), lines({"invoice_date": at(5)}), scratch).select("invoice_date_id")) == [(1,)]


def test_keys_of_several_columns(spark, scratch):
    known = scratch.cut(spark.createDataFrame([(1, "a", None), (2, "b", 1)], "id long, x string, y int"), "known")
    more = spark.createDataFrame([("a", None), ("a", 1), ("b", 1), (None, None)], "x string, y int")
    found = operators.extend_dense_key(known, more, ["x", "y"], [more.x.asc_nulls_last(), more.y.asc()], "id", scratch)
    assert rows(found) == [(1, "a", None), (2, "b", 1), (3, "a", 1), (4, None, None)]


def event(seq, **fields):
    base = dict(seq=seq, layer="raw", batch_id=f"b{seq // 2}", table="raw_orders", status="SUCCESS" if seq % 2 else "STARTED")
    return tuple({**base, **fields}.get(c.name) for c in schemas.LOAD_EVENTS.columns)


def test_ten_thousand_events_end_up_in_one_file(spark, scratch):
    log = audit.AuditLog(spark, scratch.new_path("log"))
    events = spark.createDataFrame([event(n) for n in range(10_000)], schemas.LOAD_EVENTS.schema)
    events.repartition(120).write.parquet(log.path)
    before = rows(audit.audit_latest(log.events()))
    assert log.compact() == 120
    assert len(list_files(spark, log.path, ".parquet")) == 1
    assert rows(audit.audit_latest(log.events())) == before
    assert log.compact() == 0
    # Numbers go on from the highest.
    log.start(schemas.RAW_ORDERS, "next")
    assert log.events().filter("batch_id = 'next'").first()["seq"] == 10_000


def test_no_task_sorts_or_compares_a_whole_log(spark, scratch, monkeypatch):
    log = audit.AuditLog(spark, scratch.new_path("log"))
    events = spark.createDataFrame([event(n) for n in range(2_000)], schemas.LOAD_EVENTS.schema)
    events.repartition(20).write.parquet(log.path)
    plans = []
    write = DataFrameWriter.parquet

    def seen(self, path, *more, **options):
        plans.append((path, self._df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, path, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    assert log.compact() == 20
    one_task = [plan for path, plan in plans if path == log.path]
    assert len(one_task) == 1 and "Sort" not in one_task[0] and "Aggregate" not in one_task[0]
    assert rows(log.events()) == rows(events)


def test_events_in_two_files_count_once(spark, scratch):
    log = audit.AuditLog(spark, scratch.new_path("log"))
    events = spark.createDataFrame([event(n) for n in range(6)], schemas.LOAD_EVENTS.schema)
    for _ in range(2):  # as if a driver had died between writing and deleting
        events.coalesce(1).write.mode("append").parquet(log.path)
    assert log.events().count() == 6
    assert log.compact() == 2 and log.events().count() == 6


def test_files_of_a_long_log_stay_few(spark, scratch, monkeypatch):
    monkeypatch.setattr(audit, "COMPACT_AFTER", 5)
    log = audit.AuditLog(spark, scratch.new_path("log"))
    for n in range(9):
        log.finish(log.start(schemas.RAW_ORDERS, f"b{n}"), audit.SUCCESS, n)
    assert len(list_files(spark, log.path, ".parquet")) <= 6
    states = audit.audit_latest(log.events())
    assert rows(states.select("batch_id", "row_count")) == [(f"b{n}", n) for n in range(9)]


def test_a_failed_batch_is_resumed_where_it_stopped(spark, sheet, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "in"), str(tmp_path / "dwh")
    sheet(*SHEET).write.parquet(landing)
    warehouse = Warehouse(spark, root)

    def lost(*_):
        raise RuntimeError("lost")

    def run(resume):
        return run_pipeline(spark, landing, root, fmt="parquet", resume=resume)

    with monkeypatch.context() as patch:
        patch.setattr(runner, "build_fact", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run(resume=True)  # nothing to resume: a new batch
    batch = run(resume=True)
    assert batch.row_counts == dict(
        raw_orders=6, stg_orders_raw_clean=6, stg_orders_valid=4, dim_customer=3, dim_product=3, dim_date=4, fact_sales=3,
    )
    events = audit.stage_events(warehouse.log.events())
    assert events.select("batch_id").distinct().count() == 1
    assert rows(events.filter("status = 'STARTED'").groupBy("layer").count()) == [("business", 8), ("raw", 1), ("staging", 2)]
    assert audit.audit_latest(events).filter("status <> 'SUCCESS'").isEmpty()
    # The last batch has succeeded, so the next one is new; and so is one over other files.
    assert run(resume=True).batch_id != batch.batch_id
    with monkeypatch.context() as patch:
        patch.setattr(runner, "build_fact", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run(resume=False)
    sheet(SHEET[0]).write.mode("append").parquet(landing)
    assert run(resume=True).row_counts["raw_orders"] == 7
    with pytest.raises(ValueError, match="folder"):
        run_pipeline(spark, sheet(*SHEET), root, resume=True)


def test_pinned_tables_stay_with_their_batch(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), "pin_test_")
    first = run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    names = warehouse.pin(first.batch_id, "pin_test_first")
    warehouse.create_layers()
    run_pipeline(spark, sheet(*SHEET[:3]), str(tmp_path))
    warehouse.create_layers()
    assert len(names) == 7
    assert spark.table("pin_test_first.fact_sales").count() == 3
    assert spark.table("pin_test_business.fact_sales").count() == 2
    assert spark.table("pin_test_first.dim_date").agg({"invoice_date": "min"}).first()[0] == datetime.datetime(2010, 12, 1, 8, 26)
    for name in ("pin_test_first", *(f"pin_test_{layer}" for layer in schemas.LAYERS)):
        spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")

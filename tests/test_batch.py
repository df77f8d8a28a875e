"""Whole batches: results, reruns, failures, log and snapshots."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll import schemas
from tillroll.__main__ import main
from tillroll.plans import runner
from tillroll.plans.runner import run_pipeline
from tillroll.scratch import list_folders, shared_folder
from tillroll.sources import audit
from tillroll.sources.landing import write_landing
from tillroll.sources.warehouse import Warehouse

SHEET = (
    ("536365", " 85123a", "White holder ", "6", "2010-12-01 08:26:00", "2.55", "17850", "United Kingdom"),
    (" 536365", "85123A", "WHITE HOLDER", "6", "2010-12-01 08:26:00", "2.55", "17850", "united kingdom "),
    ("536366", "22633", "Hand warmer", "6", "2010-12-01 08:28:00", "1.85", "17850", "United Kingdom"),
    ("c536379", "D", "Discount, \"big\"", "-1", "2010-12-01 09:41:00", "27.50", "14527", "France"),
    ("536414", "22139", None, "56", "2010-12-01 11:52:00", "0.00", None, "United Kingdom"),
    ("536500", "22633", "NA", "2", None, "1.85", "13047", "United Kingdom"),
)
FACT = [
    (1, "536365", "85123A", 17850, 6, False),
    (2, "536366", "22633", 17850, 6, False),
    (3, "C536379", "D", 14527, -1, True),
]


def contents(warehouse):
    """All tables without load times."""
    return {
        t.name: rows(warehouse.read(t).drop("ingestion_ts"))
        for t in schemas.TABLES
    }


def test_csv_folder_to_star_schema(spark, sheet, tmp_path):
    write_landing(sheet(*SHEET), str(tmp_path / "in"))
    batch = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "dwh"))
    assert batch.row_counts == dict(
        raw_orders=6, stg_orders_raw_clean=6, stg_orders_valid=4, dim_customer=3, dim_product=3,
        dim_date=4, fact_sales=3,
    )
    warehouse = Warehouse(spark, str(tmp_path / "dwh"))
    fact = warehouse.read(schemas.FACT_SALES)
    assert rows(
        fact.select("fact_id", "invoice_no", "stock_code", "customer_id", "quantity", "return_flag")
    ) == FACT
    for table in schemas.TABLES:
        stored = warehouse.read(table)
        assert stored.schema == table.schema
        assert stored.count() == batch.row_counts[table.name]
        assert stored.filter("ingestion_ts is null").isEmpty()

    log = audit.load_log(warehouse.log.events(), "raw").collect()
    assert [(r.file_name, r.status, r.row_count) for r in log] == [(str(tmp_path / "in"), "SUCCESS", 6)]
    assert log[0].started_at < log[0].finished_at
    staging = audit.load_log(warehouse.log.events(), "staging")
    assert rows(staging.select("table", "status", "row_count")) == [
        ("stg_orders_raw_clean", "SUCCESS", 6), ("stg_orders_valid", "SUCCESS", 4)
    ]
    assert audit.load_log(warehouse.log.events(), "business").count() == 4
    assert audit.stage_durations(warehouse.log.events()).filter("seconds >= 0").count() == 7


def test_a_rerun_gives_the_same_tables(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    first = contents(warehouse)
    run_pipeline(spark, sheet(*reversed(SHEET)), str(tmp_path))
    assert contents(warehouse) == first
    twice = sheet(*SHEET).union(sheet(*SHEET))
    run_pipeline(spark, twice, str(tmp_path))
    after = contents(warehouse)
    for table in ("stg_orders_valid", "dim_customer", "dim_product", "dim_date", "fact_sales"):
        assert after[table] == first[table]


def test_empty_sheet(spark, sheet, tmp_path):
    batch = run_pipeline(spark, sheet(SHEET[0]).limit(0), str(tmp_path))
    assert set(batch.row_counts.values()) == {0}


def test_a_bad_cell_stops_the_batch_and_keeps_the_old_tables(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    before = contents(warehouse)
    bad = (*SHEET[0][:3], "6.0", *SHEET[0][4:])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_pipeline(spark, sheet(bad), str(tmp_path))
    after = contents(warehouse)
    assert len(after["raw_orders"]) == 1
    assert {k: v for k, v in after.items() if k != "raw_orders"} == {
        k: v for k, v in before.items() if k != "raw_orders"
    }
    states = audit.audit_latest(audit.stage_events(warehouse.log.events()))
    failed = states.filter("status = 'FAILED'").collect()
    assert [(r.table, r.row_count) for r in failed] == [("stg_orders_raw_clean", None)]
    assert "6.0" in failed[0].error_message and failed[0].finished_at is not None
    assert states.filter(F.col("batch_id") == failed[0].batch_id).count() == 2


def test_a_missing_quantity_stops_at_the_fact(spark, sheet, tmp_path):
    no_quantity = (*SHEET[0][:3], None, *SHEET[0][4:])
    with pytest.raises(Exception, match="quantity NOT NULL"):
        run_pipeline(spark, sheet(no_quantity), str(tmp_path))
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.read(schemas.ORDERS_VALID).count() == 1
    for table in (schemas.DIM_DATE, schemas.DIM_PRODUCT, schemas.DIM_CUSTOMER, schemas.FACT_SALES):
        assert warehouse.read(table).isEmpty()
        assert list_folders(spark, f"{tmp_path}/business/{table.name}") == []


def test_old_lines_keep_their_dates_after_a_failed_batch(spark, sheet, tmp_path):
    """An earlier date would shift every date key, if dates were published without the fact."""
    warehouse = Warehouse(spark, str(tmp_path))
    line = lambda no, date, quantity="1": (no, "A", "CUP", quantity, f"{date} 08:00:00", "1.00", "7", "UK")
    first = [line("1", "2010-12-01"), line("2", "2010-12-02")]
    run_pipeline(spark, sheet(*first), str(tmp_path))

    def dates():
        fact = warehouse.read(schemas.FACT_SALES)
        found = fact.join(warehouse.read(schemas.DIM_DATE), "invoice_date_id")
        return rows(found.select("invoice_no", F.col("invoice_date").cast("string")))

    expected = [("1", "2010-12-01 08:00:00"), ("2", "2010-12-02 08:00:00")]
    assert dates() == expected
    with pytest.raises(Exception, match="quantity NOT NULL"):
        run_pipeline(spark, sheet(*first, line("3", "2010-11-30", None)), str(tmp_path))
    assert dates() == expected
    run_pipeline(spark, sheet(*first, line("3", "2010-11-30")), str(tmp_path))
    assert dates() == [*expected, ("3", "2010-11-30 08:00:00")]


def test_only_one_batch_may_be_open(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.log.open_batch("dead")
    with pytest.raises(audit.BatchOpenError, match="dead"):
        run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path), take_over=True, verify_keys=False)
    run_pipeline(spark, sheet(*SHEET[:1]), str(tmp_path), verify_keys=False)
    ended = audit.audit_latest(warehouse.log.events()).filter("batch_id = 'dead'").first()
    assert ended.status == "FAILED" and "taken over" in ended.error_message
    seqs = [r.seq for r in warehouse.log.events().select("seq").collect()]
    assert sorted(seqs) == list(range(1, len(seqs) + 1))


def test_of_two_batches_that_open_at_once_one_withdraws(spark, tmp_path):
    log, other = (Warehouse(spark, str(tmp_path)).log for _ in range(2))
    log._append({**audit._batch("a"), "status": "STARTED"})
    other._last_seq = 0
    other._append({**audit._batch("b"), "status": "STARTED"})
    assert [batch for _, batch in log._open_batches()] == ["a", "b"]


def test_the_log_follows_its_own_numbers_and_not_the_clock(spark, sheet, tmp_path, monkeypatch):
    run_pipeline(spark, sheet(*SHEET), str(tmp_path), verify_keys=False)
    early = datetime.datetime(1990, 1, 1)
    monkeypatch.setattr(audit, "_now", lambda: early)
    batch = run_pipeline(spark, sheet(*SHEET[:1]), str(tmp_path), verify_keys=False)
    warehouse = Warehouse(spark, str(tmp_path))
    assert set(warehouse.current_batches().values()) == {batch.batch_id}


def test_long_file_names_are_refused(spark, tmp_path):
    log = Warehouse(spark, str(tmp_path)).log
    assert log.start(schemas.RAW_ORDERS, "b", "x" * 255 + "  ")["file_name"] == "x" * 255
    with pytest.raises(ValueError, match="255"):
        log.start(schemas.RAW_ORDERS, "b", "x" * 256)


def test_line_breaks_in_cells_are_named(spark, sheet, tmp_path):
    broken = (*SHEET[0][:2], "two\nlines", *SHEET[0][3:])
    write_landing(sheet(broken), str(tmp_path / "in"))
    with pytest.raises(ValueError, match="multi_line"):
        run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "dwh"))
    run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "dwh"), multi_line=True, verify_keys=False)


def test_a_namespace_of_others_is_not_dropped(spark, tmp_path):
    spark.sql(f"CREATE NAMESPACE mine_raw LOCATION '{tmp_path}/elsewhere'")
    try:
        with pytest.raises(ValueError, match="prefix"):
            Warehouse(spark, str(tmp_path), prefix="mine_").create_layers(drop=True)
    finally:
        spark.sql("DROP NAMESPACE mine_raw CASCADE")


def test_failure_in_any_later_stage(spark, sheet, tmp_path):
    """Business tables change all at once or not at all, and a failed stage leaves no folder."""
    warehouse = Warehouse(spark, str(tmp_path))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path), verify_keys=False)

    def fail(*args):
        raise ArithmeticError("planted")

    for position in range(3, len(schemas.TABLES)):
        table = schemas.TABLES[position]
        old = warehouse.current_batches()
        builder = "build_fact" if table is schemas.FACT_SALES else f"build_{table.name}"
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(runner, builder, fail)
            with pytest.raises(ArithmeticError):
                run_pipeline(spark, sheet(*SHEET), str(tmp_path), verify_keys=False)
        new = warehouse.current_batches()
        for i, t in enumerate(schemas.TABLES):
            assert (new[t.layer, t.name] == old[t.layer, t.name]) == (i >= 3)
            assert len(list_folders(spark, f"{tmp_path}/{t.layer}/{t.name}")) == (1 if i >= 3 else position - 1)


def test_a_stage_that_never_ended_shows_as_started(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.log.start(schemas.RAW_ORDERS, "b1", "sheet.csv")
    state = audit.audit_latest(warehouse.log.events()).first()
    assert (state.status, state.finished_at, state.file_name) == ("STARTED", None, "sheet.csv")
    assert audit.stage_durations(warehouse.log.events()).isEmpty()
    assert warehouse.read(schemas.RAW_ORDERS).isEmpty()


def test_catalog_tables_follow_the_snapshots(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create_layers(drop=True)
    assert {"raw", "staging", "business", "marts", "audit"} <= {
        d.name for d in spark.catalog.listDatabases()
    }
    assert spark.table("business.fact_sales").count() == 0
    run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    assert spark.table("business.fact_sales").count() == 3
    assert spark.table("audit.load_events").count() == 16
    logged = spark.sql("SELECT `table`, status, row_count FROM audit.business_load_log")
    assert rows(logged)[-1] == ("fact_sales", "SUCCESS", 3) and logged.count() == 4
    assert spark.table("audit.staging_load_log").columns[:2] == ["batch_id", "table"]
    assert spark.table("audit.raw_load_log").columns[:2] == ["batch_id", "file_name"]
    run_pipeline(spark, sheet(*SHEET[:1]), str(tmp_path))
    assert spark.sql("SELECT max(fact_id) FROM business.fact_sales").first()[0] == 1
    assert spark.table("audit.load_events").count() == 32
    # A new catalog over the same folder finds the current snapshots.
    warehouse.create_layers(drop=True)
    assert spark.table("raw.raw_orders").count() == 1
    for layer in schemas.LAYERS:
        spark.sql(f"DROP NAMESPACE {layer} CASCADE")


def test_old_snapshots_are_dropped_on_request(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for _ in range(2):
        run_pipeline(spark, sheet(*SHEET), str(tmp_path), verify_keys=False)
    before = contents(warehouse)
    folder = f"{tmp_path}/business/fact_sales"
    assert len(list_folders(spark, folder)) == 2
    assert len(warehouse.drop_old_snapshots(keep=1)) == 7
    assert list_folders(spark, folder) == [warehouse.current_batches()["business", "fact_sales"]]
    assert contents(warehouse) == before


def test_a_batch_leaves_nothing_in_the_shared_folder(spark, sheet, tmp_path):
    before = list_folders(spark, shared_folder(spark))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path), verify_keys=False)
    assert list_folders(spark, shared_folder(spark)) == before


def test_command_line(spark, sheet, tmp_path, capfd):
    lines = sheet(*SHEET[:1]).select(*schemas.SHEET_HEADERS)
    lines = lines.withColumn("InvoiceDate", F.lit("12/1/2010 8:26"))
    write_landing(lines, str(tmp_path / "in"))
    main(
        [str(tmp_path / "in"), str(tmp_path / "dwh"), "--skip-key-checks",
         "--timestamp-format", "M/d/yyyy H:mm", "--keep-snapshots", "1"]
    )
    assert Warehouse(spark, str(tmp_path / "dwh")).read(schemas.FACT_SALES).count() == 1
    assert capfd.readouterr().out.count("SUCCESS") == 7

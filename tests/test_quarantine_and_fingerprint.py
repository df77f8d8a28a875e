"""Rows set aside, fingerprints of tables, and what the log says about them."""

import json

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_batch import SHEET
from tillroll import operators, schemas
from tillroll.operators import fingerprint_checks, read_fingerprint
from tillroll.operators.cleanse import CONCURRENT_WRITERS
from tillroll.plans.runner import run_pipeline
from tillroll.sources import audit
from tillroll.sources.warehouse import Warehouse


def cells(spark, *values):
    return spark.createDataFrame(list(values), "quantity string, invoice_date string, unit_price string, customer_id string")


GOOD = ("2", "2010-12-01 08:26:00", "2.50", "7")


def test_all_faults_of_a_row_are_kept(spark, scratch):
    df = cells(spark, GOOD, ("x", "40513", "no", "1.5"), (None, None, None, None))
    taken, refused = operators.split_casts(df, schemas.TYPED_COLUMNS, scratch)
    assert taken.count() == 2
    [row] = refused.collect()
    assert [(f.column, f.value) for f in row.faults] == [("quantity", "x"), ("invoice_date", "40513"), ("unit_price", "no"), ("customer_id", "1.5")]
    assert [f.reason for f in row.faults] == ["no whole number", "no full date", "no number", "no whole number"]


@pytest.mark.parametrize("good, bad", [(0, 0), (2, 0), (0, 2)])
def test_either_part_may_be_empty(spark, scratch, good, bad):
    df = cells(spark, *[GOOD] * good, *[("x", *GOOD[1:])] * bad) if good + bad else cells(spark, GOOD).limit(0)
    taken, refused = operators.split_casts(df, schemas.TYPED_COLUMNS, scratch)
    assert (taken.count(), refused.count()) == (good, bad)
    assert dict(taken.dtypes)["unit_price"] == "decimal(10,2)"


def test_what_is_taken_is_what_strict_casts_take(spark, scratch):
    values = ["1", "-1", "2147483648", " 3", "1e2", "", None, "0x1", "1.0", "99999999.99", "99999999.995", "100000000", "2010-02-30", "2012-02-29"]
    for column in schemas.TYPED_COLUMNS:
        at = list(schemas.TYPED_COLUMNS).index(column)
        for value in values:
            row = (*GOOD[:at], value, *GOOD[at + 1 :])
            df = cells(spark, row)
            fault = df.select(F.size(operators.cast_faults(schemas.TYPED_COLUMNS)).alias("n")).first()["n"]
            try:
                operators.cast_strict(df, schemas.TYPED_COLUMNS).collect()
                strict = 0
            except Exception:
                strict = 1
            assert fault == strict, (column, value)


def test_other_timestamp_forms(spark, scratch):
    df = cells(spark, ("1", "12/1/2010 8:26", "1", "1"), ("1", "2010-12-01", "1", "1"))
    taken, refused = operators.split_casts(df, schemas.TYPED_COLUMNS, scratch, "M/d/yyyy H:mm")
    assert str(taken.first()["invoice_date"]) == "2010-12-01 08:26:00"
    assert refused.first()["faults"][0]["reason"] == "not of the form M/d/yyyy H:mm"


def test_a_batch_sets_bad_rows_aside(spark, sheet, tmp_path):
    bad = (*SHEET[0][:3], "6.0", *SHEET[0][4:])
    batch = run_pipeline(spark, sheet(*SHEET, bad), str(tmp_path), quarantine=True)
    warehouse = Warehouse(spark, str(tmp_path))
    assert (batch.row_counts["stg_orders_raw_clean"], batch.row_counts["stg_orders_refused"]) == (6, 1)
    [row] = warehouse.read(schemas.ORDERS_REFUSED).collect()
    assert (row.invoice_no, row.quantity, row.faults[0].reason) == ("536365", "6.0", "no whole number")
    assert batch.row_counts["fact_sales"] == 3


def fingerprint(df):
    result = df.agg(*(c.alias(n) for n, c in fingerprint_checks(df.columns).items())).first().asDict()
    return json.loads(read_fingerprint(result, df.columns))


def test_order_and_files_do_not_matter_but_every_value_does(spark):
    df = spark.range(1000).selectExpr("id AS a", "id % 7 AS b", "if(id % 3 = 0, null, string(id)) AS c")
    own = fingerprint(df)
    assert fingerprint(df.orderBy(F.desc("a")).repartition(5)) == own
    changed = fingerprint(df.withColumn("b", F.when(F.col("a") == 17, 99).otherwise(F.col("b"))))
    assert {k for k in own if own[k] != changed[k]} == {"*", "b"}
    # The same values in other rows, a row more, and copies of a row.
    assert {k for k in own if own[k] != fingerprint(df.withColumn("b", (F.col("a") + 7 * 142 - 993) % 7))[k]} <= {"*", "b"}
    assert fingerprint(df.union(df.limit(1)))["*"] != own["*"]
    assert fingerprint(df.limit(1).union(df.limit(1)))["*"] != fingerprint(df.limit(0))["*"]


def test_nulls_are_not_skipped(spark):
    left = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    right = spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string")
    assert fingerprint(left)["*"] != fingerprint(right)["*"]
    moved = spark.createDataFrame([("x", "y"), (None, None)], "a string, b string")
    assert fingerprint(left)["a"] == fingerprint(moved)["a"]
    assert fingerprint(left)["*"] != fingerprint(moved)["*"]


def test_the_log_names_what_a_rerun_changed(spark, sheet, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    assert audit.rerun_differences(warehouse.log.events()).isEmpty()
    run_pipeline(spark, sheet(*reversed(SHEET)), str(tmp_path))
    found = audit.rerun_differences(warehouse.log.events())
    assert found.count() == 7 and found.filter("size(changed) > 0").isEmpty()
    dearer = [(*r[:5], "9.99", *r[6:]) if r[1] == "22633" else r for r in SHEET]
    run_pipeline(spark, sheet(*dearer), str(tmp_path))
    changed = {r.table: r.changed for r in audit.rerun_differences(warehouse.log.events()).collect()}
    assert changed["fact_sales"] == ["*", "total_amount", "unit_price"]
    assert changed["dim_customer"] == changed["dim_date"] == []


def test_each_business_table_has_its_own_end(spark, sheet, tmp_path):
    run_pipeline(spark, sheet(*SHEET), str(tmp_path))
    log = rows(audit.audit_latest(Warehouse(spark, str(tmp_path)).log.events().filter("layer = 'business'")).select("started_at", "finished_at"))
    assert len({end for _, end in log}) == 4
    assert all(end <= start for (_, end), (start, _) in zip(log, log[1:], strict=False))


def test_rows_are_not_sorted_to_be_split(spark, scratch, monkeypatch):
    seen = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(
        DataFrameWriter, "parquet", lambda self, path, *a, **o: (seen.append(spark.conf.get(CONCURRENT_WRITERS)), write(self, path, *a, **o))
    )
    before = spark.conf.get(CONCURRENT_WRITERS)
    cells = spark.createDataFrame(
        [("2010-02-30", "1.5"), ("2012-02-29 23:59", "1e2"), ("2010-12-01 24:00", "1,5"), ("2010-00-01", "E"), ("2010-12-32", "-.5")], "d string, p string"
    )
    taken, refused = operators.split_casts(cells, {"d": "timestamp_ntz", "p": "decimal(10,2)"}, scratch)
    assert seen == ["2"] and spark.conf.get(CONCURRENT_WRITERS) == before
    assert [(str(r.d), str(r.p)) for r in taken.collect()] == [("2012-02-29 23:59:00", "100.00")]
    date = "no such date or time"
    assert {r.d: [tuple(x) for x in r.faults] for r in refused.collect()} == {
        "2010-02-30": [("d", "2010-02-30", date)], "2010-12-32": [("d", "2010-12-32", date)],
        "2010-12-01 24:00": [("d", "2010-12-01 24:00", date), ("p", "1,5", "no number")],
        "2010-00-01": [("d", "2010-00-01", date), ("p", "E", "no number")],
    }

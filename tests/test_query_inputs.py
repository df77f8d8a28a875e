"""What the registered queries hand to their batches."""

import pytest

from checks import queries
from tillroll.sources.warehouse import ConstraintError

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def sources(monkeypatch):
    """The sources of batches that are not run."""
    given = []

    def run(spark, source, root, **options):
        given.append(source)
        if len(given) == 2:
            raise ConstraintError("quantity NOT NULL")

    monkeypatch.setattr(queries, "run_pipeline", run)
    return given


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_bad_line_costs_no_second_sheet(spark, sources):
    queries._failed_second_batch(spark, FOLDER)
    first, second = sources
    assert _plan(second).count("Join") == _plan(first).count("Join")
    bad = second.exceptAll(first).collect()
    assert [r.asDict() for r in bad] == [
        {c: None for c in first.columns} | {"InvoiceNo": "0", "StockCode": "X", "CustomerID": "1", "InvoiceDate": "1900-01-01 00:00:00"}
    ]


def test_a_sheet_is_dealt_anew_to_as_many_tasks_as_the_session_asks(spark, sources):
    with pytest.raises(ConstraintError):
        queries.rerun_fingerprint(spark, FOLDER)
    first, second = sources
    plan = second._jdf.queryExecution().sparkPlan().toString()
    assert "hashpartitioning" in plan and "REPARTITION_BY_COL" in plan
    assert second.exceptAll(first).isEmpty() and first.exceptAll(second).isEmpty()


def test_buckets_hold_only_what_the_fact_takes(spark, monkeypatch):
    def stop(lines, *_, **__):
        raise InterruptedError(",".join(lines.columns))

    monkeypatch.setattr(queries, "line_buckets", stop)
    with pytest.raises(InterruptedError, match="^invoice_no,stock_code,invoice_date,quantity,customer_id,unit_price$"):
        queries.colocated_star(spark, FOLDER)

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from tillroll import schemas
from tillroll.scratch import Scratch
from tillroll.session import local_session

CLEAN_SCHEMA = ", ".join(f"{c.name} {c.spark_type}" for c in schemas.ORDERS_CLEAN.columns[:-1])


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    own = Scratch(spark)
    yield own
    own.clear()


@pytest.fixture
def sheet(spark):
    """A frame under the headers of the order sheet, from rows of texts."""
    schema = ", ".join(f"{h} string" for h in schemas.SHEET_HEADERS)
    return lambda *rows: spark.createDataFrame([tuple(r) for r in rows], schema)


@pytest.fixture
def raw(spark):
    """Raw order lines; give only the columns that matter."""
    schema = ", ".join(f"{c} string" for c in schemas.ORDER_COLUMNS)

    def make(*rows: dict):
        base = dict(
            invoice_no="1", stock_code="A", description="CUP", quantity="2",
            invoice_date="2010-12-01 08:26:00", unit_price="2.50", customer_id="7", country="UK",
        )
        return spark.createDataFrame(
            [tuple({**base, **r}[c] for c in schemas.ORDER_COLUMNS) for r in rows], schema
        )

    return make


@pytest.fixture
def lines(spark):
    """Typed order lines; give only the columns that matter."""

    def make(*rows: dict):
        base = dict(
            invoice_no="1", stock_code="A", description="CUP", quantity=2, invoice_date=at(1),
            unit_price=Decimal("2.50"), customer_id=7, country="UK",
        )
        return spark.createDataFrame(
            [tuple({**base, **r}[c] for c in schemas.ORDER_COLUMNS) for r in rows], CLEAN_SCHEMA
        )

    return make


def at(day: int, hour: int = 8) -> datetime.datetime:
    return datetime.datetime(2010, 12, day, hour, 26)


def rows(df) -> list[tuple]:
    """All rows as tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

from decimal import Decimal

import pytest

from tests.conftest import at, rows
from tillroll import operators, schemas
from tillroll.sources.warehouse import ConstraintError, Warehouse


def test_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a")], "i int, s string")
    assert rows(operators.pk_violations(df, ["i", "s"])) == [(1, "a", 2), (None, "a", 1)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "ref int, s string")
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert rows(operators.fk_violations(child, parent, {"ref": "id"})) == [(2, "y")]
    same_name = parent.withColumnRenamed("id", "ref")
    assert rows(operators.fk_violations(child, same_name, {"ref": "ref"})) == [(2, "y")]


def test_not_null(lines):
    df = lines({}, {"quantity": None}, {"unit_price": None})
    assert operators.null_violations(df, ["quantity", "unit_price"]).count() == 2
    assert operators.null_violations(df, ["country"]).isEmpty()


def test_length(lines):
    df = lines({"description": "x" * 50}, {"description": "x" * 51}, {"description": "x" * 50 + "   "})
    assert operators.length_violations(df, {"description": 50}).count() == 1


def test_range(spark):
    df = spark.createDataFrame(
        [(Decimal("99999999.99"),), (Decimal("100000000.00"),), (None,)], "v decimal(18,2)"
    )
    found = operators.range_violations(df, {"v": "decimal(10,2)"})
    assert rows(found) == [(Decimal("100000000.00"),)]


def test_distinct_dense_keys(spark):
    keys = spark.range(1, 100_001)
    assert operators.distinct_dense_keys(keys, "id").first()[0] == 100_000
    doubled = keys.union(spark.range(500, 600))
    assert operators.distinct_dense_keys(doubled, "id").first()[0] == 100_000
    assert operators.distinct_dense_keys(keys.limit(0), "id").first()[0] == 0


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_length_is_checked_while_writing(warehouse, lines):
    with pytest.raises(ConstraintError, match=r"description VARCHAR\(50\)"):
        warehouse.write_snapshot(schemas.ORDERS_CLEAN, lines({"description": "x" * 51}), "b")


def fact_rows(spark, *changes: dict):
    base = dict(
        fact_id=1, invoice_no="1", stock_code="A", customer_id=7, invoice_date_id=1, quantity=1,
        unit_price=Decimal("1.00"), total_amount=Decimal("1.00"), return_flag=False,
    )
    schema = ", ".join(f"{c.name} {c.spark_type}" for c in schemas.FACT_SALES.columns[:-1])
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schema)


@pytest.mark.parametrize("column", ["quantity", "unit_price", "stock_code"])
def test_required_fields_are_checked_while_writing(spark, warehouse, column):
    with pytest.raises(ConstraintError, match=f"{column} NOT NULL"):
        warehouse.write_snapshot(schemas.FACT_SALES, fact_rows(spark, {column: None}), "b")


def test_keys_are_checked_after_writing(spark, warehouse, lines):
    customers = spark.createDataFrame([(7, "UK", at(1), at(1))], warehouse_schema(schemas.DIM_CUSTOMER))
    products = spark.createDataFrame([("A", "CUP")], warehouse_schema(schemas.DIM_PRODUCT))
    dates = spark.createDataFrame([(1, at(1), 1, 12, 2010, 3)], warehouse_schema(schemas.DIM_DATE))
    for batch, rows_, message in (
        ("good", fact_rows(spark, {}, {"fact_id": 2}), None),
        ("double", fact_rows(spark, {}, {}), "PRIMARY KEY"),
        ("orphan", fact_rows(spark, {}, {"fact_id": 2, "stock_code": "B"}), "FOREIGN KEY stock_code"),
    ):
        warehouse.write_snapshot(schemas.DIM_CUSTOMER, customers, batch)
        warehouse.write_snapshot(schemas.DIM_PRODUCT, products, batch)
        warehouse.write_snapshot(schemas.DIM_DATE, dates, batch)
        assert warehouse.write_snapshot(schemas.FACT_SALES, rows_, batch) == 2
        if message:
            with pytest.raises(ConstraintError, match=f"{message} broken by 1 keys"):
                warehouse.check_keys(schemas.FACT_SALES, batch, 2)
            path = warehouse.violations_path(schemas.FACT_SALES, batch, message)
            assert spark.read.parquet(path).count() == 1
        else:
            warehouse.check_keys(schemas.FACT_SALES, batch, 2)


def warehouse_schema(table):
    return ", ".join(f"{c.name} {c.spark_type}" for c in table.columns[:-1])


def test_double_parent_key_fails(spark, warehouse):
    twice = spark.createDataFrame([("A", "CUP"), ("A", "MUG")], warehouse_schema(schemas.DIM_PRODUCT))
    warehouse.write_snapshot(schemas.DIM_PRODUCT, twice, "b")
    with pytest.raises(ConstraintError, match="PRIMARY KEY"):
        warehouse.check_keys(schemas.DIM_PRODUCT, "b", 2)

import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from checks.order_lines import order_lines
from tests.conftest import at, rows
from tests.test_cleanse import plan_of
from tillroll import operators, plans

FOLDER = "/root/testdata/sf0.001"


def test_main_country_ties_go_to_the_first_name(lines):
    df = lines(
        {"customer_id": 1, "country": "USA"}, {"customer_id": 1, "country": "FRANCE"},
        {"customer_id": 2, "country": None}, {"customer_id": 2, "country": "UK"},
        {"customer_id": 3, "country": None}, {"customer_id": 3, "country": None},
        {"customer_id": 3, "country": "UK"},
    )
    expected = [(1, "FRANCE"), (2, "UK"), (3, None)]
    assert rows(plans.customer_main_country(df)) == expected
    assert rows(plans.build_dim_customer(df).select("customer_id", "country")) == expected


def test_invoice_span_skips_missing_times(lines):
    df = lines(
        {"invoice_date": at(3)}, {"invoice_date": None}, {"invoice_date": at(1)},
        {"customer_id": 8, "invoice_date": None},
    )
    assert rows(plans.customer_invoice_span(df)) == [(7, at(1), at(3)), (8, None, None)]


_order = st.fixed_dictionaries(
    {
        "customer_id": st.integers(1, 3),
        "country": st.sampled_from([None, "", "UK", "USA"]),
        "invoice_date": st.sampled_from([None, at(1), at(2), at(3)]),
    }
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_order, min_size=1, max_size=20))
def test_customers_equal_the_join_of_country_and_span(lines, data):
    df = lines(*data)
    joined = plans.customer_main_country(df).join(plans.customer_invoice_span(df), "customer_id")
    assert rows(plans.build_dim_customer(df)) == rows(joined)


def test_customers_need_one_scan(lines, scratch):
    plan = plan_of(plans.build_dim_customer(scratch.cut(lines({}), "lines")))
    assert plan.count("FileScan") == 1
    assert "Join" not in plan


def test_most_frequent_description(lines):
    df = lines(
        {"stock_code": "A", "description": "MUG"}, {"stock_code": "A", "description": "MUG"},
        {"stock_code": "A", "description": "CUP"},
        {"stock_code": "B", "description": None}, {"stock_code": "B", "description": "Z"},
        {"stock_code": "C", "description": None},
    )
    assert rows(plans.build_dim_product(df)) == [("A", "MUG"), ("B", "Z"), ("C", None)]


def test_dates_have_time_grain_and_one_row_without_time(lines, scratch):
    sunday = datetime.datetime(2010, 12, 5, 10, 0)
    df = lines(
        {"invoice_date": sunday}, {"invoice_date": sunday},
        {"invoice_date": sunday + datetime.timedelta(minutes=1)},
        {"invoice_date": None}, {"invoice_date": None},
        {"invoice_date": datetime.datetime(2010, 12, 4, 23, 59)},
    )
    found = sorted((tuple(r) for r in plans.build_dim_date(df, scratch).collect()))
    assert [r[0] for r in found] == [1, 2, 3, 4]
    assert found[0][2:] == (4, 12, 2010, 6)
    assert found[1][1:] == (sunday, 5, 12, 2010, 0)
    assert found[3][1:] == (None,) * 5


def build_all(valid, scratch):
    return (
        plans.build_dim_date(valid, scratch),
        plans.build_dim_product(valid),
        plans.build_dim_customer(valid),
    )


def test_lines_without_time_are_not_sold(lines, scratch):
    valid = lines({"invoice_no": "C9", "quantity": -2}, {"invoice_no": "2", "invoice_date": None})
    fact = plans.build_fact(valid, *build_all(valid, scratch), scratch)
    assert [tuple(r) for r in fact.collect()] == [
        (1, "C9", "A", 7, 1, -2, Decimal("2.50"), Decimal("-5.00"), True)
    ]


@pytest.fixture(params=["broadcast", "shuffle"])
def size_limit(spark, request):
    """Runs a test below and beyond the size up to which dimensions are broadcast."""
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    if request.param == "shuffle":
        for limit in limits:
            spark.conf.set(limit, "-1")
    yield request.param
    for limit in limits:
        spark.conf.unset(limit)


def test_unknown_dimension_rows_leave_no_gap(spark, lines, scratch, size_limit):
    valid = scratch.cut(
        lines(
            {"invoice_no": "1", "stock_code": "A"}, {"invoice_no": "2", "stock_code": "B"},
            {"invoice_no": "3", "stock_code": "A"}, {"invoice_no": "4", "customer_id": 8},
            {"invoice_no": "5", "invoice_date": at(9)}, {"invoice_no": "6"},
        ),
        "valid",
    )
    date, product, customer = build_all(valid, scratch)
    fact = plans.build_fact(
        valid,
        scratch.cut(date.filter("day <> 9"), "date"),
        scratch.cut(product.filter("stock_code <> 'B'"), "product"),
        scratch.cut(customer.filter("customer_id <> 8"), "customer"),
        scratch,
    )
    assert rows(fact.select("fact_id", "invoice_no")) == [(1, "1"), (2, "3"), (3, "6")]


def test_known_only_keeps_rows_and_drops_missing_keys(spark, scratch, size_limit):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    both = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(operators.known_only(df, both, "k", scratch)) == [(1, "a"), (1, "b"), (2, "c")]
    assert rows(operators.known_only(df, both.filter("k <> 2"), "k", scratch)) == [(1, "a"), (1, "b")]


def test_known_rows_are_not_shuffled_for_a_large_dimension(spark, scratch):
    hot = "if(id % 3 = 0, 0, id)"
    rows_ = scratch.cut(spark.range(30_000).selectExpr(f"{hot} AS k", "id"), "rows")
    dimension = scratch.cut(spark.range(1, 30_000).selectExpr("id AS k"), "dimension")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        known = operators.known_only(rows_, dimension, "k", scratch)
        assert "hashpartitioning" not in plan_of(known)
        assert known.count() == 20_000
        everything = operators.known_only(rows_, spark.range(0, 30_000).selectExpr("id AS k"), "k", scratch)
        assert everything.count() == 30_000
        none = operators.known_only(rows_, dimension.filter("k < 0"), "k", scratch)
        assert none.isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def star(spark):
    """The star schema of the smallest tables, written once."""
    from tillroll.scratch import Scratch

    own = Scratch(spark)
    clean = own.cut(plans.build_clean(plans.build_raw(order_lines(spark, FOLDER))), "clean")
    valid = own.cut(plans.build_valid(clean), "valid")
    date = own.cut(plans.build_dim_date(valid, own), "date")
    product = own.cut(plans.build_dim_product(valid), "product")
    customer = own.cut(plans.build_dim_customer(valid), "customer")
    fact = own.cut(plans.build_fact(valid, date, product, customer, own), "fact")
    yield dict(clean=clean, valid=valid, date=date, product=product, customer=customer, fact=fact)
    own.clear()


def test_row_counts(star):
    counts = {name: df.count() for name, df in star.items()}
    assert counts == dict(clean=6473, valid=5390, date=1330, product=199, customer=150, fact=5383)
    assert operators.rejected_rows(star["clean"]).count() == 695
    assert star["fact"].filter("return_flag").count() == 1757


def test_invariants(star):
    fact, valid = star["fact"], star["valid"]
    keys = ["invoice_no", "stock_code", "invoice_date", "quantity", "customer_id"]
    assert valid.groupBy(*keys).count().filter("count > 1").isEmpty()
    for name, key in (("date", "invoice_date_id"), ("product", "stock_code"), ("customer", "customer_id")):
        assert operators.pk_violations(star[name], [key]).isEmpty()
        assert operators.fk_violations(fact, star[name], {key: key}).isEmpty()
    assert fact.count() == valid.filter("invoice_date is not null").count()
    assert fact.filter("return_flag <> startswith(invoice_no, 'C')").isEmpty()
    assert star["customer"].filter("first_invoice > last_invoice").isEmpty()
    assert sorted(r.fact_id for r in fact.select("fact_id").collect()) == list(range(1, 5384))


def test_fact_is_the_same_whatever_is_broadcast(star, scratch, size_limit):
    fact = plans.build_fact(star["valid"], star["date"], star["product"], star["customer"], scratch)
    assert rows(fact) == rows(star["fact"])

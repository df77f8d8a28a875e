import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_cleanse import plan_of
from tillroll import operators, plans, schemas


def test_first_copy_by_description_price_country(lines):
    survivor = operators.dedupe(
        lines(
            {"description": None, "unit_price": Decimal("1.00")},
            {"description": "MUG"},
            {"description": "CUP", "unit_price": None},
            {"description": "CUP", "unit_price": Decimal("3.00"), "country": None},
            {"description": "CUP", "unit_price": Decimal("3.00"), "country": "FRANCE"},
        )
    ).collect()
    assert len(survivor) == 1
    assert (survivor[0].unit_price, survivor[0].country) == (Decimal("3.00"), "FRANCE")


def test_missing_key_parts_are_equal(lines):
    df = lines({"invoice_date": None, "quantity": None}, {"invoice_date": None, "quantity": None}, {})
    assert operators.dedupe(df).count() == 2


def test_copies_are_cut_before_the_shuffle(lines, scratch):
    """A key that holds a third of the rows sends one row per task."""
    hot = [{"description": f"D{i:04d}"} for i in range(300)]
    cold = [{"invoice_no": str(i)} for i in range(2, 602)]
    stored = scratch.cut(lines(*hot, *cold), "lines")
    valid = plans.build_valid(stored)
    plan = plan_of(valid)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert plan.count("Exchange") == 1
    assert valid.count() == 601
    assert valid.filter("invoice_no = '1'").first().description == "D0000"


_line = st.fixed_dictionaries(
    {
        "invoice_no": st.sampled_from(["1", "2"]),
        "invoice_date": st.none(),
        "quantity": st.sampled_from([None, 1]),
        "description": st.sampled_from([None, "CUP", "MUG"]),
        "country": st.sampled_from([None, "UK", "USA"]),
    }
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_line, min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_valid_rows_do_not_depend_on_input_order(lines, data, rng):
    valid = rows(plans.build_valid(lines(*data)))
    shuffled = list(data) * 2
    rng.shuffle(shuffled)
    assert rows(plans.build_valid(lines(*shuffled))) == valid
    assert rows(plans.build_valid(plans.build_valid(lines(*data)))) == valid


def test_top_n(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 5)], "k string, v int")
    top = operators.top_n_per_group(df, ["k"], [F.desc("v")], 2, "place")
    assert rows(top) == rows(
        spark.createDataFrame([("a", 3, 1), ("a", 2, 2), (None, 5, 1)], "k string, v int, p int")
    )


@pytest.mark.parametrize("n", [0, -1])
def test_top_n_takes_positive_sizes_only(spark, n):
    with pytest.raises(ValueError):
        operators.top_n_per_group(spark.range(3), ["id"], [F.col("id")], n)


def test_top_n_beyond_the_early_cut_splits_a_hot_group(spark):
    """Parts of a group are cut in many tasks; the last one gets at most n rows of each."""
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS g", "id AS v")
    found = operators.top_n_per_group(hot, ["g"], [F.desc("v")], 5_000, "nth")
    plan = plan_of(found)
    assert plan.count("Window ") >= 2 and "_salt" in plan
    assert found.filter("g = 0").agg(F.count("v"), F.min("v"), F.max("nth")).first()[:] == (5_000, 15_000, 5_000)
    assert found.count() == 25_000


@pytest.mark.parametrize("size", [0, 1, 7, 5000])
def test_dense_key_is_a_global_row_number(spark, scratch, size):
    rng = random.Random(size)
    data = [(rng.choice(["a", "b", None]), i if i else None) for i in range(size)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, i int").repartition(5)
    order = [F.asc_nulls_last("g"), F.asc_nulls_last("i")]
    keyed = operators.assign_dense_key(df, order, "id", scratch)
    expected = df.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("id"), "g", "i"
    )
    assert keyed.columns == ["id", "g", "i"]
    assert dict(keyed.dtypes)["id"] == "bigint"
    assert rows(keyed) == rows(expected)


def test_dense_key_is_stable_when_read_again(spark, scratch):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v"))
    keyed = operators.assign_dense_key(df, [F.asc("v")], "id", scratch)
    assert keyed.exceptAll(keyed).count() == 0
    assert rows(keyed) == rows(keyed)


def test_dense_key_uses_several_ranges_and_one_task_only_for_their_list(spark, scratch):
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v"))
        keyed = operators.assign_dense_key(df, [F.asc("v")], "id", scratch)
    finally:
        spark.conf.set(conf, "true")
    ranges = spark.read.parquet(f"{scratch.path}/001-id").select(F.shiftright("_position", 33))
    assert ranges.distinct().count() == 4
    assert [r.id for r in keyed.orderBy("v").collect()] == list(range(1, 10_001))
    # Only the row counts of the ranges meet in one task.
    rows_side = plan_of(keyed).split("BroadcastExchange")[0]
    assert "SinglePartition" not in rows_side


def test_dense_key_in_fact_order(lines, scratch):
    valid = plans.build_valid(lines({"invoice_no": "2"}, {"invoice_no": "10"}, {"invoice_no": "1"}))
    fact = plans.build_fact(
        valid,
        plans.build_dim_date(valid, scratch),
        plans.build_dim_product(valid),
        plans.build_dim_customer(valid),
        scratch,
    )
    assert [r.invoice_no for r in fact.orderBy("fact_id").collect()] == ["1", "10", "2"]
    assert fact.columns == [c for c in schemas.FACT_SALES.column_names if c != "ingestion_ts"]

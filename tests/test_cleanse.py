from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import at, rows
from tillroll import operators, plans, schemas
from tillroll.functions import return_flag, total_amount

HEADERS = list(schemas.SHEET_HEADERS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_found_by_name(sheet):
    df = sheet(["1", "A", "CUP", "2", "2010-12-01 08:26:00", "2.50", "7", "UK"])
    moved = df.select(*reversed(HEADERS))
    assert operators.rename_columns(moved).columns == list(schemas.ORDER_COLUMNS)
    assert rows(operators.rename_columns(moved)) == rows(df)


def test_missing_and_unknown_columns_fail(sheet):
    df = sheet(["1", "A", "CUP", "2", "2010-12-01 08:26:00", "2.50", "7", "UK"])
    with pytest.raises(ValueError, match="Country"):
        operators.rename_columns(df.drop("Country"))
    with pytest.raises(ValueError, match="Region"):
        operators.rename_columns(df.withColumnRenamed("Country", "Region"))


def test_missing_texts_become_null_and_blanks_stay(raw):
    cells = ["NA", "n/a", "", "nan", "\\N", None, "  ", "na", "NAN", "CUP"]
    kept = plans.build_raw(raw(*({"description": c} for c in cells)))
    assert [r.description for r in kept.collect()] == [None] * 6 + ["  ", "na", "NAN", "CUP"]


def test_text_is_upper_case_without_outer_spaces(raw):
    df = operators.standardize_text(raw({"description": "  red Cup ", "country": "\tuk "}))
    row = df.first()
    assert (row.description, row.country) == ("RED CUP", "\tUK")


def test_typed_values(raw):
    row = plans.build_clean(
        raw({"quantity": " -6 ", "unit_price": "2.675", "invoice_date": "2010-12-05 08:26:00"})
    ).first()
    assert row.quantity == -6
    assert row.unit_price == Decimal("2.68")
    assert row.invoice_date == at(5)


def test_half_cents_round_away_from_zero(raw):
    df = plans.build_clean(raw({"unit_price": "-2.675"}, {"unit_price": "1.005"}))
    assert [r.unit_price for r in df.collect()] == [Decimal("-2.68"), Decimal("1.01")]


@pytest.mark.parametrize(
    "cell",
    [
        {"quantity": "6.0"},
        {"quantity": "  "},
        {"quantity": "99999999999"},
        {"customer_id": ""},
        {"unit_price": "abc"},
        {"unit_price": "NaN"},
        {"unit_price": "100000000.00"},
        {"invoice_date": "12/1/2010 8:26"},
    ],
)
def test_a_value_of_the_wrong_form_fails(raw, cell):
    with pytest.raises(Exception):
        plans.build_clean(raw(cell, {})).collect()


def test_another_timestamp_form_can_be_given(raw):
    df = plans.build_clean(raw({"invoice_date": "12/1/2010 8:26"}), "M/d/yyyy H:mm")
    assert df.first().invoice_date == at(1)


def test_lenient_casts_are_refused(spark, raw):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            plans.build_clean(raw({}))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_required_keys_and_rejected_rows_are_complements(lines):
    df = lines({}, {"customer_id": None}, {"invoice_no": None, "stock_code": None}, {"quantity": None})
    assert operators.required_keys(df).count() == 2
    rejected = operators.rejected_rows(df)
    assert sorted(r.reason for r in rejected.collect()) == ["customer_id", "invoice_no,stock_code"]


def test_a_blank_key_is_a_key(raw):
    assert plans.build_valid(plans.build_clean(raw({"invoice_no": "   "}))).first().invoice_no == ""


def test_key_filter_reaches_the_scan(spark, lines, scratch):
    stored = scratch.cut(lines({}), "lines")
    plan = plan_of(operators.required_keys(stored))
    for key in schemas.REQUIRED_KEYS:
        assert f"IsNotNull({key})" in plan


def test_cleaning_does_not_shuffle(raw, scratch):
    plan = plan_of(plans.build_clean(plans.build_raw(scratch.cut(raw({}), "raw"))))
    assert "Exchange" not in plan


def test_return_flag_and_total(lines):
    df = lines({"invoice_no": "C1", "quantity": -3}, {"invoice_no": "1C"}, {"invoice_no": None})
    found = df.select(return_flag().alias("flag"), total_amount().alias("total")).collect()
    assert [r.flag for r in found] == [True, False, False]
    assert [r.total for r in found] == [Decimal("-7.50"), Decimal("5.00"), Decimal("5.00")]


def test_total_overflow_fails(lines):
    df = lines({"quantity": 1000, "unit_price": Decimal("99999999.00")})
    with pytest.raises(Exception):
        df.select(total_amount().alias("total")).collect()


def test_defaults(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "id int, return_flag boolean")
    found = operators.apply_defaults(df).orderBy("id").collect()
    assert [r.return_flag for r in found] == [True, False, False]
    assert len({r.ingestion_ts for r in found}) == 1 and found[0].ingestion_ts is not None


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" abZ\t", max_size=6), min_size=1, max_size=8))
def test_standardising_twice_changes_nothing(raw, texts):
    once = operators.standardize_text(raw(*({"description": t} for t in texts)))
    assert rows(operators.standardize_text(once)) == rows(once)
    assert [r.description for r in once.collect()] == [t.strip(" ").upper() for t in texts]


@pytest.mark.parametrize("cell", ["40513", "101201", "2010", "2010-12", "2010-12-01 08:26:00+05:00", "2010-12-01T08:26:00Z"])
@pytest.mark.parametrize("form", [None, "M/d/yyyy H:mm"])
def test_cells_that_are_no_full_date_fail(raw, cell, form):
    df = raw({"invoice_date": cell})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        operators.cast_strict(df, schemas.TYPED_COLUMNS, form).collect()
    if form is None:
        assert operators.bad_timestamps(df, "invoice_date").count() == 1


@pytest.mark.parametrize("cell", ["2010-12-01", "2010-12-01 08:26", "2010-12-01T08:26:00.5", None])
def test_full_dates_are_taken(raw, cell):
    df = raw({"invoice_date": cell})
    assert operators.cast_strict(df, schemas.TYPED_COLUMNS).count() == 1
    assert operators.bad_timestamps(df, "invoice_date").isEmpty()

"""What a job leaves on disk besides its tables."""

import os

import pytest

from checks import queries
from tests.conftest import rows
from tillroll import schemas
from tillroll.scratch import FREE_SHUFFLES, SPLIT_BYTES, list_files, write_compact
from tillroll.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"


def _shuffled(spark) -> list[str]:
    """Shuffle files of the session that are still there."""
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sorted(f for place in top for _, _, files in os.walk(place) for f in files if f.startswith("shuffle_"))


def _codecs(spark, path: str) -> set[str]:
    files = spark.read.parquet(path).inputFiles()
    return {f.split(".")[-2] for f in files}


def test_shuffles_go_with_the_write_that_made_them(spark, scratch, lines):
    before = _shuffled(spark)
    dealt = lines(*({"invoice_no": str(n)} for n in range(100))).repartition(4, "invoice_no")
    dealt.write.parquet(scratch.new_path("plain"))
    assert _shuffled(spark) != before  # as Spark does by itself
    before = _shuffled(spark)
    cut = scratch.cut(dealt, "cut")
    warehouse = Warehouse(spark, scratch.new_path("warehouse"))
    assert warehouse.write_snapshot(schemas.ORDERS_VALID, dealt, "batch") == 100
    assert set(_shuffled(spark)) <= set(before)
    assert rows(warehouse.read(schemas.ORDERS_VALID, "batch").select(*cut.columns)) == rows(cut) == rows(dealt)
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_tables_and_intermediate_tables_are_stored_small(spark, scratch, lines):
    few = lines({"invoice_no": "1"}, {"invoice_no": "2"})
    path = scratch.new_path("warehouse")
    Warehouse(spark, path).write_snapshot(schemas.ORDERS_VALID, few, "batch")
    scratch.cut(few, "cut")
    assert _codecs(spark, f"{path}/staging/stg_orders_valid/batch") == {"zstd"}
    assert _codecs(spark, f"{scratch.path}/002-cut") == {"zstd"}


@pytest.mark.parametrize("size", ["1m", "1048576b", "1024KB", "1048576"])
def test_splits_of_compact_files_are_half_as_large(spark, scratch, size):
    source, out = scratch.new_path("source"), scratch.new_path("out")
    # Eight files of a fifth of a split: five go into one, and two into half of one.
    spark.range(0, 36_000, 1, 8).selectExpr("id", "uuid() AS text").write.option("compression", "none").parquet(source)
    settings = {SPLIT_BYTES: size, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        write_compact(spark.read.parquet(source), out)
        assert spark.conf.get(SPLIT_BYTES) == size
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(list_files(spark, out, ".parquet")) == 4
    assert spark.read.parquet(out).count() == 36_000


def test_the_sheet_of_a_rerun_is_stored_before_it_is_dealt_anew(spark, monkeypatch):
    given = []
    monkeypatch.setattr(queries, "run_pipeline", lambda spark, source, root: given.append(source))
    monkeypatch.setattr(queries, "_differences", lambda warehouse: None)
    queries.rerun_fingerprint(spark, FOLDER)
    plans = [source._jdf.queryExecution().optimizedPlan().toString() for source in given]
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)
    assert rows(given[0]) == rows(queries._sheet(spark, FOLDER))


def test_the_star_shuffles_no_descriptions_to_its_customers(spark, monkeypatch):
    class Empty:
        def read(self, table):
            return spark.createDataFrame([], table.schema)

    monkeypatch.setattr(queries, "_failed_second_batch", lambda *_: Empty())
    # Without the optimizer, which drops joins of empty tables; the last join stands first.
    plan = queries.published_star(spark, FOLDER)._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert ["stock_code" in joins[0], "customer_id" in joins[1], "invoice_date_id" in joins[2]] == [True] * 3

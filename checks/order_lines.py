"""Retail order lines derived from order, customer, part and nation tables.

Stands in for an order sheet of any size. The cells are untidy on purpose: odd blanks and
case, half cents, missing keys, dates and descriptions, and copies of rows, some of them with
another price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import ORDER_COLUMNS

# The columns that are read, stated so that no file has to be opened to plan a query.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string",
    "nation": "n_nationkey int, n_name string",
}

_HOME = "n_nationkey = (c_nationkey + if(o_orderkey % 7 = 0, 1, 0)) % 25"

_CELLS = {
    "invoice_no": "concat(if(l_returnflag = 'R', 'c', ''), l_orderkey)",
    "stock_code": "if(l_partkey % 401 = 0, NULL, concat(' p', l_partkey, 'a'))",
    "description": """CASE WHEN l_partkey % 7 = 0 AND l_linenumber % 2 = 0 THEN NULL
                           WHEN l_linenumber % 3 = 0 THEN concat(p_name, ' ', lower(p_type))
                           ELSE concat('  ', p_name, ' ') END""",
    "quantity": "string(int(if(l_returnflag = 'R', -l_quantity, l_quantity)))",
    "invoice_date": """if(l_orderkey % 503 = 0, NULL,
                          concat(date(o_orderdate), ' ',
                                 lpad(string(o_orderkey % 10 + 8), 2, '0'), ':',
                                 lpad(string(o_orderkey % 60), 2, '0'), ':00'))""",
    "unit_price": "concat(cast(l_extendedprice AS decimal(12,2)), '5')",
    "customer_id": "if(l_orderkey % 11 = 0, NULL, string(o_custkey))",
    "country": "lower(n_name)",
}

_COPY = {
    "invoice_no": "concat(' ', upper(invoice_no))",
    "stock_code": "concat(upper(stock_code), ' ')",
    "description": "upper(description)",
    "unit_price": "if(l_partkey % 26 = 0, '1.005', unit_price)",
    "country": "concat(' ', country)",
}


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")

    orders = (
        table("orders")
        .join(table("customer"), F.expr("o_custkey = c_custkey"))
        .join(table("nation"), F.expr(_HOME))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    # Orders and lines are both large: shuffled even where a size estimate says otherwise.
    lines = (
        table("lineitem")
        .join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .selectExpr("l_partkey", *(f"{cell} AS {name}" for name, cell in _CELLS.items()))
    )
    row = ", ".join(ORDER_COLUMNS)
    copy = ", ".join(f"{_COPY.get(c, c)} AS {c}" for c in ORDER_COLUMNS)
    # Rows and copies in one pass over the joins instead of a union of two.
    return lines.selectExpr(
        f"inline(if(l_partkey % 13 = 0, array(struct({row}), struct({copy})), array(struct({row}))))"
    )

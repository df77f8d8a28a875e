"""Every table of the warehouse: columns, declared types, keys and required fields.

Spark's Parquet tables keep types but neither keys nor lengths, so the declarations here
are what the writer casts to and what the checks in ``operators.quality`` read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StructType

# Header of the order sheet -> column name.
SHEET_HEADERS = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}
ORDER_COLUMNS = tuple(SHEET_HEADERS.values())

# Cell texts that mean "missing" (the documented pandas defaults), and the
# NULL marker of the landing files.
NULL_MARKER = "\\N"
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", NULL_MARKER,
)

# Layers whose loads are logged.
LOG_LAYERS = ("raw", "staging", "business")
LAYERS = ("raw", "staging", "business", "marts", "audit")

REQUIRED_KEYS = ("customer_id", "invoice_no", "stock_code")
DEDUPE_KEYS = ("invoice_no", "stock_code", "invoice_date", "quantity", "customer_id")
# Which of several copies survives: the first in this order, missing values last.
DEDUPE_ORDER = ("description", "unit_price", "country")

TEXT_COLUMNS = ("invoice_no", "stock_code", "description", "country")
TYPED_COLUMNS = {
    "quantity": "int",
    "invoice_date": "timestamp_ntz",
    "unit_price": "decimal(10,2)",
    "customer_id": "int",
}


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False

    @property
    def max_length(self) -> int | None:
        found = re.fullmatch(r"varchar\((\d+)\)", self.type)
        return int(found.group(1)) if found else None

    @property
    def spark_type(self) -> str:
        return "string" if self.max_length else self.type


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str  # table name; the parent column has the same name


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    dense_key: bool = False  # the primary key is one column numbered 1..n

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{c.name}` {c.spark_type}" for c in self.columns))

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.type}" for c in self.columns)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}


# Fixed values, down to LOAD_EVENTS: names, types and lengths of the columns of all tables.
INGESTION_TS = Column("ingestion_ts", "timestamp_ntz")

_TYPED_ORDER = (
    Column("invoice_no", "varchar(20)"),
    Column("stock_code", "varchar(20)"),
    Column("description", "varchar(50)"),
    Column("quantity", "int"),
    Column("invoice_date", "timestamp_ntz"),
    Column("unit_price", "decimal(10,2)"),
    Column("customer_id", "int"),
    Column("country", "varchar(50)"),
    INGESTION_TS,
)

RAW_ORDERS = Table(
    "raw", "raw_orders", (*(Column(c, "string") for c in ORDER_COLUMNS), INGESTION_TS)
)
ORDERS_CLEAN = Table("staging", "stg_orders_raw_clean", _TYPED_ORDER)
# Rows with cells that do not fit their types, as texts, where a batch sets them aside.
ORDERS_REFUSED = Table(
    "staging",
    "stg_orders_refused",
    (
        *(Column(c, "string") for c in ORDER_COLUMNS),
        Column("faults", "array<struct<column:string,value:string,reason:string>>", required=True),
        INGESTION_TS,
    ),
)
ORDERS_VALID = Table("staging", "stg_orders_valid", _TYPED_ORDER)
DIM_CUSTOMER = Table(
    "business",
    "dim_customer",
    (
        Column("customer_id", "int", required=True),
        Column("country", "varchar(50)"),
        Column("first_invoice", "timestamp_ntz"),
        Column("last_invoice", "timestamp_ntz"),
        INGESTION_TS,
    ),
    primary_key=("customer_id",),
)
DIM_PRODUCT = Table(
    "business",
    "dim_product",
    (
        Column("stock_code", "varchar(20)", required=True),
        Column("description", "varchar(50)"),
        INGESTION_TS,
    ),
    primary_key=("stock_code",),
)
DIM_DATE = Table(
    "business",
    "dim_date",
    (
        Column("invoice_date_id", "int", required=True),
        Column("invoice_date", "timestamp_ntz"),
        Column("day", "int"),
        Column("month", "int"),
        Column("year", "int"),
        Column("weekday", "int"),
        INGESTION_TS,
    ),
    primary_key=("invoice_date_id",),
    dense_key=True,
)
FACT_SALES = Table(
    "business",
    "fact_sales",
    (
        Column("fact_id", "bigint", required=True),
        Column("invoice_no", "varchar(20)", required=True),
        Column("stock_code", "varchar(20)", required=True),
        Column("customer_id", "int", required=True),
        Column("invoice_date_id", "int", required=True),
        Column("quantity", "int", required=True),
        Column("unit_price", "decimal(10,2)", required=True),
        Column("total_amount", "decimal(10,2)"),
        Column("return_flag", "boolean", required=True),
        Column("ingestion_ts", "timestamp_ntz", required=True),
    ),
    primary_key=("fact_id",),
    dense_key=True,
    foreign_keys=(
        ForeignKey("stock_code", "dim_product"),
        ForeignKey("customer_id", "dim_customer"),
        ForeignKey("invoice_date_id", "dim_date"),
    ),
)

# In load order.
TABLES = (
    RAW_ORDERS, ORDERS_CLEAN, ORDERS_VALID, DIM_CUSTOMER, DIM_PRODUCT, DIM_DATE, FACT_SALES,
)

# Those, and the tables that only some batches load.
ALL_TABLES = (*TABLES, ORDERS_REFUSED)

LOAD_EVENTS = Table(
    "audit",
    "load_events",
    (
        Column("seq", "bigint", required=True),
        Column("layer", "varchar(20)", required=True),
        Column("batch_id", "varchar(36)", required=True),
        Column("table", "varchar(50)", required=True),
        Column("file_name", "varchar(255)"),
        Column("status", "varchar(20)", required=True),
        Column("row_count", "bigint"),
        Column("started_at", "timestamp_ntz"),
        Column("finished_at", "timestamp_ntz"),
        Column("error_message", "string"),
        Column("fingerprint", "string"),
    ),
)

from tillroll.plans.dimensions import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    country_counts,
    customer_invoice_span,
    customer_main_country,
    description_counts,
    distinct_dates,
    extend_dim_date,
)
from tillroll.plans.fact import (
    LINE_COLUMNS,
    build_colocated_fact,
    build_fact,
    lookup_customer,
    lookup_date_key,
    lookup_product,
)
from tillroll.plans.staging import build_clean, build_raw, build_valid, split_clean

__all__ = [
    "LINE_COLUMNS",
    "build_clean",
    "build_colocated_fact",
    "build_dim_customer",
    "build_dim_date",
    "build_dim_product",
    "build_fact",
    "build_raw",
    "build_valid",
    "country_counts",
    "customer_invoice_span",
    "customer_main_country",
    "description_counts",
    "distinct_dates",
    "extend_dim_date",
    "lookup_customer",
    "lookup_date_key",
    "lookup_product",
    "split_clean",
]

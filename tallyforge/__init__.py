"""Retail sales analytics as plain Spark DataFrame transforms."""

from tallyforge.operators.columns import require_columns, sanitize_cols, type_mismatches
from tallyforge.operators.customers import (
    bad_customers,
    clean_customers,
    enrich_customer_data,
    valid_customers,
    with_status,
)
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.orders import enrich_order_data, low_profit_orders
from tallyforge.operators.products import enrich_product_data
from tallyforge.operators.profit import (
    profit_agg,
    profit_by_customer,
    profit_by_year,
    profit_by_year_category,
    profit_by_year_customer,
)
from tallyforge.operators.quality import bad_customer_report, cast_audit, quarantine_counts
from tallyforge.plans.batch import build_gold, build_silver, run_batch
from tallyforge.sources.files import read_customers, read_orders_json, read_products_csv
from tallyforge.sources.ingest import ingest, load_file

__all__ = [
    "add_dense_key",
    "bad_customer_report",
    "bad_customers",
    "build_gold",
    "build_silver",
    "cast_audit",
    "clean_customers",
    "enrich_customer_data",
    "enrich_order_data",
    "enrich_product_data",
    "ingest",
    "load_file",
    "low_profit_orders",
    "profit_agg",
    "profit_by_customer",
    "profit_by_year",
    "profit_by_year_category",
    "profit_by_year_customer",
    "quarantine_counts",
    "read_customers",
    "read_orders_json",
    "read_products_csv",
    "require_columns",
    "run_batch",
    "sanitize_cols",
    "type_mismatches",
    "valid_customers",
    "with_status",
]

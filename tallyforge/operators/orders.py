"""The enriched order line: orders joined with valid customers and with products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.money import percent_of
from tallyforge.operators.columns import require_columns, sanitized
from tallyforge.operators.joins import join_dimension
from tallyforge.schemas import GOLD_ORDERS, ORDERS_FILE

# Fixed value: how order files write a date.
ORDER_DATE_FORMAT = "d/M/yyyy"

ORDER_COLUMNS = [sanitized(name) for name in ORDERS_FILE]


def refine_orders(orders: DataFrame) -> DataFrame:
    """Round profit to cents and parse both dates; a date that does not parse becomes NULL."""
    return orders.withColumns(
        {
            "Profit": F.round("Profit", 2),
            "Order_Date": F.try_to_date("Order_Date", ORDER_DATE_FORMAT),
            "Ship_Date": F.try_to_date("Ship_Date", ORDER_DATE_FORMAT),
        }
    )


def enrich_order_data(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """One row per order line with a known customer and a known product.

    Only the columns the result needs enter the joins, so a dimension's surrogate key, even one
    made by a window, is pruned from the plan. ``broadcast_limit``: see ``join_dimension``.
    """
    require_columns(orders, ORDER_COLUMNS, "orders")
    customers = require_columns(customers, ["Customer_ID", "Customer_Name", "Country"], "customers")
    products = require_columns(products, ["Product_ID", "Category", "Sub_Category"], "products")
    lines = refine_orders(orders)
    lines = join_dimension(
        lines, customers.select("Customer_ID", "Customer_Name", "Country"), "Customer_ID", broadcast_limit
    )
    lines = join_dimension(
        lines, products.select("Product_ID", "Category", "Sub_Category"), "Product_ID", broadcast_limit
    )
    return lines.select(*GOLD_ORDERS)


def low_profit_orders(enriched: DataFrame, below: float = 10.0) -> DataFrame:
    """Customer and profit percentage of each line whose percentage is under ``below``."""
    return enriched.select(
        "Customer_Name", percent_of(F.col("Profit"), F.col("Price")).alias("Profit_Percent")
    ).filter(F.col("Profit_Percent") < below)

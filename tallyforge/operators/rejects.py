"""Order lines that the enrichment loses, with the reason, and whether all lines are accounted for.

The inner joins drop a line whose customer or product is unknown, and double one whose id is in
a dimension twice. Here each line learns how many valid customers and how many products have its
ids, by joins with the dimensions counted by id, which never fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.columns import require_columns
from tallyforge.operators.customers import is_valid
from tallyforge.operators.joins import join_dimension

NO_CUSTOMER, UNKNOWN_CUSTOMER, INVALID_CUSTOMER = "no customer id", "unknown customer", "invalid customer"
NO_PRODUCT, UNKNOWN_PRODUCT = "no product id", "unknown product"


def with_matches(
    orders: DataFrame, checked: DataFrame, products: DataFrame, broadcast_limit: int | None = None
) -> DataFrame:
    """Adds ``reason``, empty for a line that is kept, and ``copies``, the enriched lines it makes.

    ``checked`` are all cleaned customers with their flags. A line rejected for its customer and
    its product has both reasons, separated by a comma.
    """
    require_columns(orders, ["Customer_ID", "Product_ID"], "orders")
    people = checked.groupBy("Customer_ID").agg(
        F.count("*").alias("_customers"), F.count_if(is_valid()).alias("_valid")
    )
    goods = products.groupBy("Product_ID").agg(F.count("*").alias("_products"))
    rows = join_dimension(orders, people, "Customer_ID", broadcast_limit, "left")
    rows = join_dimension(rows, goods, "Product_ID", broadcast_limit, "left")
    customer = (
        F.when(F.col("Customer_ID").isNull(), NO_CUSTOMER)
        .when(F.col("_customers").isNull(), UNKNOWN_CUSTOMER)
        .when(F.col("_valid") == 0, INVALID_CUSTOMER)
    )
    product = F.when(F.col("Product_ID").isNull(), NO_PRODUCT).when(F.col("_products").isNull(), UNKNOWN_PRODUCT)
    copies = F.coalesce(F.col("_valid") * F.col("_products"), F.lit(0).cast("bigint"))
    return rows.select(
        *[F.col(f"`{c}`") for c in orders.columns], F.concat_ws(",", customer, product).alias("reason"), copies.alias("copies")
    )


def rejected_orders(matched: DataFrame) -> DataFrame:
    """The lines that no enriched line comes from, with the reason."""
    return matched.filter(F.col("copies") == 0).drop("copies")


def reconciliation(matched: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: the lines in, those rejected, the lines that repeated ids add, the lines that are in
    ``enriched``, and ``missing``, which is 0 if in = out + rejected - added."""
    lines = matched.agg(
        F.count("*").alias("lines_in"),
        F.count_if(F.col("copies") == 0).alias("rejected"),
        F.coalesce(F.sum(F.greatest(F.col("copies") - 1, F.lit(0))), F.lit(0)).alias("added"),
    )
    # One row each, so this pairs two rows.
    both = lines.join(enriched.agg(F.count("*").alias("lines_out")), F.lit(True))
    missing = F.col("lines_in") - F.col("rejected") + F.col("added") - F.col("lines_out")
    return both.select("lines_in", "rejected", "added", "lines_out", missing.alias("missing"))


def rejection_counts(matched: DataFrame) -> DataFrame:
    """Lines for each reason."""
    return matched.filter("copies = 0").groupBy("reason").agg(F.count("*").alias("n"))


def repeated_ids(dimension: DataFrame, id_column: str) -> DataFrame:
    """The ids that a dimension has more than once, and how often."""
    return dimension.groupBy(id_column).agg(F.count("*").alias("n")).filter("n > 1")

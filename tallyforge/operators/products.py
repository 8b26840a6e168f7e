"""Product enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyforge.operators.columns import require_columns
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.registry import add_registered_key
from tallyforge.schemas import PRODUCTS, SILVER_PRODUCT


def enrich_product_data(
    df: DataFrame, key_type: str = "int", registry: tuple[str, str] | None = None
) -> DataFrame:
    """The product with ``Product_PK`` 1..n by ``Product_ID``; the key holds for one run only, unless
    ``registry`` names a table and its database that remember the keys.

    Over 2,147,483,647 products need ``key_type="bigint"``.
    """
    require_columns(df, PRODUCTS, "products")
    if registry:
        keyed = add_registered_key(df, "Product_PK", "Product_ID", *registry, key_type=key_type)
    else:
        keyed = add_dense_key(df, "Product_PK", ["Product_ID"], key_type)
    return keyed.select(*SILVER_PRODUCT)

"""The batch: source files to bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators.customers import enrich_customer_data, with_status
from tallyforge.operators.joins import BROADCAST_LIMIT
from tallyforge.operators.orders import enrich_order_data
from tallyforge.operators.products import enrich_product_data
from tallyforge.operators.profit import profit_agg
from tallyforge.schemas import ENRICHED_CUSTOMER, SILVER_CUSTOMER
from tallyforge.sinks.tables import (
    overwrite_by_status,
    overwrite_clustered,
    overwrite_partitioned,
    overwrite_table,
    qualified,
    reused,
)
from tallyforge.sources.ingest import MANIFEST, ROUTES, ingest_entries
from tallyforge.sources.ledger import ingest_new_files

# Fixed value: the name of the global view over the order lines.
ORDERS_VIEW = "enriched_ord_df"

CUSTOMER_TABLES = {
    "valid": ("silver_customer", SILVER_CUSTOMER),
    "bad": ("bad_silver_customer", ENRICHED_CUSTOMER),
    "unclassified": ("unclassified_silver_customer", ENRICHED_CUSTOMER),
}


def run_batch(
    spark: SparkSession,
    paths: Iterable[str],
    database: str = "default",
    strict: bool = False,
    multiline: bool | None = None,
    broadcast_limit: int | None = BROADCAST_LIMIT,
    options: dict | None = None,
    allow_existing: bool = False,
    key_type: str = "int",
    orders_view: str = ORDERS_VIEW,
    new_files_only: bool = False,
    stable_keys: bool = False,
) -> DataFrame:
    """Load the files, build the silver and gold tables, and return the load manifest.

    All three bronze tables must be loaded by this run; ``allow_existing`` takes one that no path
    was given for as an earlier run left it. Each layer reads the written tables of the one
    before, so a lost executor costs the step under way and nothing earlier.

    ``new_files_only`` loads the files that no such run has loaded before and adds their rows to
    the bronze tables; files that cannot be read are in the manifest and stop nothing.
    ``stable_keys``: see ``build_silver``.
    """
    if new_files_only:
        manifest = ingest_new_files(spark, paths, database, options)
        absent = [t for t in ROUTES.values() if not spark.catalog.tableExists(qualified(t, database))]
        if absent:
            raise RuntimeError(f"no file was ever loaded for {absent}")
        build_silver(spark, database, strict, key_type, stable_keys)
        build_gold(spark, database, broadcast_limit, orders_view=orders_view)
        return manifest
    entries = ingest_entries(spark, paths, database, multiline, options)
    failed = [(e["file"], e["error"]) for e in entries if e["status"] == "error" and e["table_name"]]
    if failed:
        raise RuntimeError(f"sources not loaded: {failed}")
    missing = set(ROUTES.values()).difference(e["table_name"] for e in entries)
    if missing and not allow_existing:
        unknown = [e["file"] for e in entries if not e["table_name"]]
        raise RuntimeError(f"no source for {sorted(missing)}; files of unknown kind: {unknown}")
    build_silver(spark, database, strict, key_type, stable_keys)
    build_gold(spark, database, broadcast_limit, orders_view=orders_view)
    return spark.createDataFrame(entries, MANIFEST)


def build_silver(
    spark: SparkSession,
    database: str = "default",
    strict: bool = False,
    key_type: str = "int",
    stable_keys: bool = False,
) -> None:
    """Write the checked customers by status, a table for each status, and keyed products.

    A customer with an unknown name or phone may be neither valid nor bad; it is kept as
    ``unclassified``, so the three tables hold every customer once. Every table is replaced at
    once, with the columns of this run; one whose build fails keeps its content.

    ``stable_keys`` takes surrogate keys from registries, in which an id keeps its key.
    """
    customer_keys = ("customer_keys", database) if stable_keys else None
    product_keys = ("product_keys", database) if stable_keys else None
    bronze = spark.table(qualified("bronze_customer", database))
    checked = with_status(enrich_customer_data(bronze, strict, key_type, customer_keys))
    overwrite_by_status(checked, "checked_customer", database, merge_schema=False)
    written = spark.table(qualified("checked_customer", database))
    for status, (table, columns) in CUSTOMER_TABLES.items():
        rows = written.filter(written.status == status).select(*columns)
        overwrite_table(rows, table, database, merge_schema=False)
    products = enrich_product_data(spark.table(qualified("bronze_products", database)), key_type, product_keys)
    overwrite_table(products, "silver_products", database)


def enriched_orders(
    spark: SparkSession, database: str = "default", broadcast_limit: int | None = BROADCAST_LIMIT
) -> DataFrame:
    """The enriched order lines over the bronze orders and the written silver tables."""
    return enrich_order_data(
        spark.table(qualified("bronze_orders", database)),
        spark.table(qualified("silver_customer", database)),
        spark.table(qualified("silver_products", database)),
        broadcast_limit,
    )


def build_gold(
    spark: SparkSession,
    database: str = "default",
    broadcast_limit: int | None = BROADCAST_LIMIT,
    keep_in_memory: bool = False,
    orders_view: str = ORDERS_VIEW,
) -> None:
    """Write the order lines, clustered by ``Row_ID``, and the profit aggregate by year.

    The aggregate reads five columns of the order table just written. ``keep_in_memory``
    persists the joined lines for both writes instead, which pays only while they fit.
    """
    lines = enriched_orders(spark, database, broadcast_limit)
    if keep_in_memory:
        with reused(lines):
            overwrite_clustered(lines, "gold_orders", "Row_ID", database, merge_schema=False)
            overwrite_partitioned(profit_agg(lines), "gold_profit_agg", "Year", database, merge_schema=False)
    else:
        overwrite_clustered(lines, "gold_orders", "Row_ID", database, merge_schema=False)
        written = spark.table(qualified("gold_orders", database))
        overwrite_partitioned(profit_agg(written), "gold_profit_agg", "Year", database, merge_schema=False)
    publish_orders(spark, database, orders_view)


def publish_orders(spark: SparkSession, database: str = "default", view: str = ORDERS_VIEW) -> None:
    """Register the written order lines as a global view. Its name is the application's, so
    batches over several databases in one application give each a name of its own."""
    spark.table(qualified("gold_orders", database)).createOrReplaceGlobalTempView(view)

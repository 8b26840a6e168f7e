"""Every query over the test tables, by name. Each takes ``(spark, sf_dir)``.

All of them read the whole tables. Those that write put their tables into a scratch database
in the folder the session shares between executors, and return what they read back from it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import customers as cust
from tallyforge.operators import profile, profit, quality, rejects, skew
from tallyforge.operators.columns import sanitize_cols
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.orders import enrich_order_data, low_profit_orders
from tallyforge.operators.products import enrich_product_data
from tallyforge.operators.registry import registry
from tallyforge.plans.batch import CUSTOMER_TABLES, build_silver, publish_orders, run_batch
from tallyforge.plans.bronze_sample import bronze_customers, bronze_products, order_lines
from tallyforge.plans.refresh import change_orders, refresh_profit_agg
from tallyforge.sinks.publish import publish, rollback
from tallyforge.sinks.tables import (
    overwrite_by_status,
    overwrite_clustered,
    overwrite_partitioned,
    overwrite_table,
    qualified,
)
from tallyforge.sinks.zorder import overwrite_zordered
from tallyforge.sources.files import (
    read_customers,
    read_orders_json,
    read_products_csv,
    read_table_path,
)
from tallyforge.sources.ingest import ingest, load_file, row_counts
from tallyforge.sources.ledger import ingest_new_files
from tallyforge.workspace import scratch_database, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# The filters of the two filtered reports.
REPORT_CUSTOMER = "SharedName"
REPORT_CATEGORY = "ECONOMY"

ORDERS_PER_ARRAY = 10_000
#: Lines of a compressed order file, which one task reads.
LINES_PER_FILE = 250_000


# --- frames the queries share -------------------------------------------------------------


def checked_customers(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return cust.clean_customers(bronze_customers(spark, sf_dir), strict)


def enriched_customers(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return cust.enrich_customer_data(bronze_customers(spark, sf_dir), strict)


def enriched_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_product_data(bronze_products(spark, sf_dir))


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_order_data(
        sanitize_cols(order_lines(spark, sf_dir)),
        cust.valid_customers(checked_customers(spark, sf_dir)),
        bronze_products(spark, sf_dir),
    )


def profit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.with_year(enriched_orders(spark, sf_dir))


# --- reports ------------------------------------------------------------------------------


def profit_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_by_year(profit_lines(spark, sf_dir))


def profit_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_by_customer(profit_lines(spark, sf_dir))


def profit_by_customer_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the written aggregate, so that the filter reaches the files."""
    return profit.profit_by_customer(written_aggregate(spark, sf_dir), REPORT_CUSTOMER)


def profit_by_year_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_by_year_customer(profit_lines(spark, sf_dir))


def profit_by_year_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_by_year_category(profit_lines(spark, sf_dir))


def profit_by_year_category_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_by_year_category(written_aggregate(spark, sf_dir), REPORT_CATEGORY)


def profit_reports_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four reports as grouping sets of one aggregate."""
    return profit.profit_reports(profit_lines(spark, sf_dir))


def profit_by_customer_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer's profit from the order table, whose files have Bloom filters on the name."""
    database = scratch_database(spark)
    lines = enriched_orders(spark, sf_dir)
    overwrite_clustered(lines, "gold_orders", "Row_ID", database, bloom=["Customer_Name"])
    written = profit.with_year(spark.table(qualified("gold_orders", database)))
    return profit.profit_by_customer(written, REPORT_CUSTOMER)


def gold_profit_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.profit_agg(enriched_orders(spark, sf_dir))


def written_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold aggregate as a table with a folder per year, read by name."""
    database = scratch_database(spark)
    overwrite_partitioned(gold_profit_agg(spark, sf_dir), "gold_profit_agg", "Year", database)
    return spark.table(qualified("gold_profit_agg", database))


def _written_once(df: DataFrame) -> DataFrame:
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def profit_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    written_aggregate(spark, sf_dir).createOrReplaceTempView("profit_detail_source")
    return spark.sql("SELECT * FROM profit_detail_source")


def gold_orders_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profit.row_total(enriched_orders(spark, sf_dir))


def low_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return low_profit_orders(enriched_orders(spark, sf_dir))


def _uneven_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Order lines with cleaned customers and products of which some are missing and some repeated."""
    customers = checked_customers(spark, sf_dir)
    customers = customers.filter(F.col("Customer_ID").cast("bigint") % 19 != 0)
    products = bronze_products(spark, sf_dir).filter(F.col("Product_ID").cast("bigint") % 13 != 0)
    products = products.unionByName(products.filter(F.col("Product_ID").cast("bigint") % 17 == 0))
    return sanitize_cols(order_lines(spark, sf_dir)), customers, products


def rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a valid customer or a product, with the reason."""
    matched = rejects.with_matches(*_uneven_orders(spark, sf_dir))
    return rejects.rejected_orders(matched).select("Row_ID", "Order_ID", "Customer_ID", "Product_ID", "reason")


def order_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines accounted for: those in against those enriched, rejected and added."""
    orders, customers, products = _uneven_orders(spark, sf_dir)
    enriched = enrich_order_data(orders, cust.valid_customers(customers), products)
    return rejects.reconciliation(rejects.with_matches(orders, customers, products), enriched)


def repeated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that a dimension has more than once."""
    return rejects.repeated_ids(_uneven_orders(spark, sf_dir)[2], "Product_ID")


def skewed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which a third have one customer, joined without leaving that one to a task."""
    lines = sanitize_cols(order_lines(spark, sf_dir))
    hot = F.when(F.col("Row_ID") % 3 == 0, F.lit("1")).otherwise(F.col("Customer_ID"))
    customers = cust.valid_customers(checked_customers(spark, sf_dir)).select("Customer_ID", "Customer_Name")
    joined = skew.skewed_join(lines.withColumn("Customer_ID", hot), customers.hint("merge"), "Customer_ID", tasks=64)
    return joined.select("Row_ID", "Order_ID", "Product_ID", "Customer_ID", "Customer_Name")


# --- customers, keys and quality ----------------------------------------------------------


def customer_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bronze_customers(spark, sf_dir).select("Customer_ID")
    return add_dense_key(ids, "Customer_PK", ["Customer_ID"])


def product_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bronze_products(spark, sf_dir).select("Product_ID")
    return add_dense_key(ids, "Product_PK", ["Product_ID"])


def _two_loads(df: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows of two loads; the second lacks some ids of the first and has others."""
    number = F.col(id_column).cast("bigint")
    return df.filter(number % 3 != 0), df.filter(number % 5 != 0)


def stable_customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a second load with the keys a registry gives them."""
    place = ("customer_keys", scratch_database(spark))
    first, second = _two_loads(bronze_customers(spark, sf_dir), "Customer_ID")
    cust.enrich_customer_data(first, registry=place)
    return cust.enrich_customer_data(second, registry=place).select("Customer_PK", "Customer_ID")


def stable_product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of products after two loads."""
    place = ("product_keys", scratch_database(spark))
    for load in _two_loads(bronze_products(spark, sf_dir), "Product_ID"):
        enrich_product_data(load, registry=place)
    return registry(spark, *place)


def valid_customers(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return cust.valid_customers(enriched_customers(spark, sf_dir, strict))


def bad_customers(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return cust.bad_customers(enriched_customers(spark, sf_dir, strict))


def bad_customers_loader_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.bad_customers(enriched_customers(spark, sf_dir), loader_rule=True)


def bad_customer_report(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return quality.bad_customer_report(checked_customers(spark, sf_dir, strict))


def customer_quarantine_counts(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return quality.quarantine_counts(checked_customers(spark, sf_dir, strict))


def cast_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = bronze_products(spark, sf_dir)
    return quality.cast_audit(products, {name: "int" for name in products.columns})


# What the columns of the bronze tables are to hold. Those not named hold text.
DECLARED = {
    "bronze_customer": {"Customer_ID": "int", "Phone": "double", "Postal_Code": "int"},
    "bronze_products": {"Product_ID": "int", "Product_Name": "int"},
    "bronze_orders": {
        "Customer_ID": "int", "Discount": "double", "Order_Date": "date", "Order_ID": "bigint", "Price": "double",
        "Product_ID": "int", "Profit": "double", "Quantity": "int", "Row_ID": "bigint", "Ship_Date": "date",
    },
}


def column_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of all columns of the bronze tables, a pass over each; what is exact in them."""
    frames = {
        "bronze_customer": bronze_customers(spark, sf_dir),
        "bronze_products": bronze_products(spark, sf_dir),
        "bronze_orders": sanitize_cols(order_lines(spark, sf_dir)),
    }
    found = []
    for table, df in frames.items():
        kinds = {c: DECLARED[table].get(c, "string") for c in df.columns}
        rows = profile.column_profile(df, kinds).select(*profile.EXACT)
        found.append(rows.withColumn("table_name", F.lit(table)))
    return reduce(DataFrame.unionByName, found)


# --- sources ------------------------------------------------------------------------------


def sanitize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize_cols(order_lines(spark, sf_dir))


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _write_lines(df: DataFrame, path: str) -> None:
    """Compressed JSON Lines, about a tenth of what they take as they are."""
    df.write.option("maxRecordsPerFile", LINES_PER_FILE).json(path, compression="gzip")


def _write_arrays(df: DataFrame, path: str) -> None:
    """Files of one JSON array each, of about ``ORDERS_PER_ARRAY`` rows."""
    files = max(1, df.count() // ORDERS_PER_ARRAY)
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    arrays = df.groupBy(share).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path, compression="gzip")


def _deliver(spark: SparkSession, source: str, target: str) -> None:
    """Move the files Spark's text writer made to another folder, as ``.json`` files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path(source)):
        name, text, packed = status.getPath().getName().partition(".txt")
        if text and not files.rename(status.getPath(), path(f"{target}/a-{name}.json{packed}")):
            raise OSError(f"could not move {name} to {target}")


def source_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the three sources, as a shop would deliver them."""
    folder = shared_folder(spark)
    _write_lines(order_lines(spark, sf_dir), f"{folder}/Orders.json")
    _write_csv(bronze_products(spark, sf_dir), f"{folder}/Products.csv")
    _write_csv(bronze_customers(spark, sf_dir), f"{folder}/Customer.csv")
    return folder


def source_paths(folder: str) -> list[str]:
    return [f"{folder}/{name}" for name in ("Customer.csv", "Orders.json", "Products.csv")]


# The queries below write their source files first, unless they are given a folder of them.


def scan_orders_json(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    path = f"{folder or shared_folder(spark)}/Orders.json"
    if folder is None:
        _write_lines(order_lines(spark, sf_dir), path)
    return sanitize_cols(read_orders_json(spark, path))


def scan_orders_json_array(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Order files that hold one array each, the form a shop exports."""
    path = f"{folder or shared_folder(spark)}/Orders_arrays"
    if folder is None:
        _write_arrays(order_lines(spark, sf_dir), path)
    return sanitize_cols(read_orders_json(spark, path))


def scan_products_csv(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    path = f"{folder or shared_folder(spark)}/Products.csv"
    if folder is None:
        _write_csv(bronze_products(spark, sf_dir), path)
    return read_products_csv(spark, path)


def scan_customer_files(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    path = f"{folder or shared_folder(spark)}/Customer.csv"
    if folder is None:
        _write_csv(bronze_customers(spark, sf_dir), path)
    return read_customers(spark, path)


def table_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    enriched_products(spark, sf_dir).write.parquet(path)
    return read_table_path(spark, path)


def ingest_manifest(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All three sources loaded, along with a file of unknown kind."""
    folder = folder or source_files(spark, sf_dir)
    paths = [*source_paths(folder), f"{folder}/Returns.csv"]
    manifest = ingest(spark, paths, scratch_database(spark))
    return manifest.select("file", "table_name", "status", "row_count")


def ingest_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines delivered in several places, in both forms of JSON, loaded as one table."""
    folder, database = shared_folder(spark), scratch_database(spark)
    lines = order_lines(spark, sf_dir)
    third = F.pmod(F.col("`Row ID`"), F.lit(3))
    paths = [f"{folder}/Orders_{i}.json" for i in range(2)]
    for i, path in enumerate(paths):
        _write_lines(lines.filter(third == i), path)
    # The second folder has files of both forms, those with arrays first.
    _write_arrays(lines.filter(third == 2), f"{folder}/arrays")
    _deliver(spark, f"{folder}/arrays", paths[1])
    ingest(spark, paths, database)
    return spark.table(qualified("bronze_orders", database))


def _truncate(spark: SparkSession, source: str, target: str) -> None:
    """A copy of the first half of the largest file of a folder."""
    path, utils = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.commons.io.IOUtils
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    largest = max(files.listStatus(path(source)), key=lambda status: status.getLen())
    whole, half = files.open(largest.getPath()), files.create(path(target))
    utils.copyLarge(whole, half, 0, largest.getLen() // 2)
    whole.close()
    half.close()


def _delivered_twice(spark: SparkSession, sf_dir: str, database: str) -> list[DataFrame]:
    """Order lines delivered in two parts to a folder that also has a truncated file, which is
    loaded after each delivery. Returns both manifests."""
    folder = f"{shared_folder(spark)}/Orders"
    lines = order_lines(spark, sf_dir)
    part = F.pmod(F.col("`Row ID`"), F.lit(3))
    _write_lines(lines.filter(part < 2), f"{folder}/first")
    _truncate(spark, f"{folder}/first", f"{folder}/damaged.json.gz")
    first = ingest_new_files(spark, [folder], database)
    lines.filter(part == 2).write.json(f"{folder}/second")
    return [first, ingest_new_files(spark, [folder], database)]


def ingest_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of two deliveries, each file loaded once and a truncated one left out."""
    database = scratch_database(spark)
    _delivered_twice(spark, sf_dir, database)
    return spark.table(qualified("bronze_orders", database))


def ingest_ledger_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files that each of two loads took, and the files that failed."""
    manifests = _delivered_twice(spark, sf_dir, scratch_database(spark))
    runs = [m.withColumn("run", F.lit(i)) for i, m in enumerate(manifests, 1)]
    return reduce(DataFrame.unionByName, runs).groupBy("run", "status").agg(
        F.sum("row_count").alias("n"), F.count_if(F.col("status") == "error").alias("failed_files")
    )


def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table, counted while its source is loaded."""
    folder = shared_folder(spark)
    _write_lines(order_lines(spark, sf_dir), f"{folder}/Orders.json")
    _write_csv(bronze_products(spark, sf_dir), f"{folder}/Products.csv")
    bronze_customers(spark, sf_dir).write.parquet(f"{folder}/Customer.parquet")
    names = ["Customer.parquet", "Orders.json", "Products.csv"]
    return row_counts(ingest(spark, [f"{folder}/{n}" for n in names], scratch_database(spark)))


def loaded_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products read through the session's view on what was loaded last."""
    path = f"{shared_folder(spark)}/Products.csv"
    _write_csv(bronze_products(spark, sf_dir), path)
    load_file(path, spark, scratch_database(spark))
    return spark.table("bronze_products_loaded")


def batch_profit_agg(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The whole batch, from source files to the gold aggregate, which is read by name."""
    database = scratch_database(spark)
    run_batch(spark, source_paths(folder or source_files(spark, sf_dir)), database)
    return spark.sql(f"SELECT * FROM {qualified('gold_profit_agg', database)}")


def batch_customer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in each of the three tables the batch splits them into."""
    database = scratch_database(spark)
    ingest(spark, source_paths(source_files(spark, sf_dir)), database)
    build_silver(spark, database)
    counts = [
        spark.table(qualified(table, database)).agg(F.lit(status).alias("status"), F.count("*").alias("n"))
        for status, (table, _) in CUSTOMER_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def orders_global_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines read through the global view on the written table."""
    database = scratch_database(spark)
    overwrite_table(enriched_orders(spark, sf_dir), "gold_orders", database)
    publish_orders(spark, database, view := f"orders_{database}")
    return spark.table(f"global_temp.{view}")


# --- sinks --------------------------------------------------------------------------------


def gold_profit_agg_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_aggregate(spark, sf_dir)


def incremental_profit_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate after lines of two years were added and corrected; only these are rebuilt."""
    database = scratch_database(spark)
    lines = enriched_orders(spark, sf_dir)
    new, corrected = F.col("Row_ID") % 4 == 0, F.col("Row_ID") % 10 == 1
    overwrite_clustered(lines.filter(~new), "gold_orders", "Row_ID", database)
    written = spark.table(qualified("gold_orders", database))
    overwrite_partitioned(profit.profit_agg(written), "gold_profit_agg", "Year", database)
    changed = lines.filter((new | corrected) & F.year("Order_Date").isin(1995, 1997))
    changed = changed.withColumn("Profit", F.when(corrected, -F.col("Profit")).otherwise(F.col("Profit")))
    refresh_profit_agg(spark, change_orders(spark, changed, database), database)
    return spark.table(qualified("gold_profit_agg", database))


def atomic_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate after a rebuild that fails in its last rows, and one that is taken back."""
    database = scratch_database(spark)
    agg = _written_once(gold_profit_agg(spark, sf_dir))  # the joins run once for all builds
    overwrite_partitioned(agg, "gold_profit_agg", "Year", database)
    latest = agg.agg(F.max("Year")).first()[0]
    no_profit = F.raise_error(F.lit("this build fails")).cast("double")
    broken = agg.withColumn("Profit", F.when(F.col("Year") == latest, no_profit).otherwise(F.col("Profit")))
    try:
        overwrite_partitioned(broken, "gold_profit_agg", "Year", database)
        raise AssertionError("the build should have failed")
    except PySparkException as failure:
        if "this build fails" not in str(failure):
            raise
    publish(agg.withColumn("Profit", -F.col("Profit")), "gold_profit_agg", database, "Year")
    rollback(spark, "gold_profit_agg", database)
    return spark.table(qualified("gold_profit_agg", database))


def gold_orders_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    overwrite_clustered(enriched_orders(spark, sf_dir), "gold_orders", "Row_ID", database)
    return spark.table(qualified("gold_orders", database))


def gold_orders_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines laid out by number and date at once."""
    database = scratch_database(spark)
    overwrite_zordered(enriched_orders(spark, sf_dir), "gold_orders", ["Row_ID", "Order_Date"], database)
    return spark.table(qualified("gold_orders", database))


def customers_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checked customers written in one pass, one folder per status, and read back."""
    database = scratch_database(spark)
    checked = cust.with_status(enriched_customers(spark, sf_dir))
    overwrite_by_status(checked, "checked_customer", database)
    return spark.table(qualified("checked_customer", database))


def schema_evolving_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, overwritten by rows that lack two of the columns and bring a new one."""
    database = scratch_database(spark)
    overwrite_table(bronze_products(spark, sf_dir), "silver_products", database)
    prices = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("Product_ID"),
        F.col("p_name").alias("Product_Name"),
        F.col("p_retailprice").alias("List_Price"),
    )
    overwrite_table(prices, "silver_products", database)
    return spark.table(qualified("silver_products", database))


def all_queries() -> dict[str, Query]:
    def strictly(query) -> Query:
        return lambda spark, sf_dir: query(spark, sf_dir, strict=True)

    return {
        "profit_by_year": profit_by_year,
        "profit_by_customer": profit_by_customer,
        "profit_by_customer_filtered": profit_by_customer_filtered,
        "profit_by_year_customer": profit_by_year_customer,
        "profit_by_year_category": profit_by_year_category,
        "profit_by_year_category_filtered": profit_by_year_category_filtered,
        "profit_detail": profit_detail,
        "profit_reports_cube": profit_reports_cube,
        "profit_by_customer_bloom": profit_by_customer_bloom,
        "gold_profit_agg": gold_profit_agg,
        "gold_profit_agg_partitioned": gold_profit_agg_partitioned,
        "atomic_rebuild": atomic_rebuild,
        "incremental_profit_agg": incremental_profit_agg,
        "gold_orders_count": gold_orders_count,
        "gold_orders_clustered": gold_orders_clustered,
        "gold_orders_zorder": gold_orders_zorder,
        "enriched_customers": enriched_customers,
        "enriched_customers_strict": strictly(enriched_customers),
        "enriched_products": enriched_products,
        "enriched_orders": enriched_orders,
        "rejected_orders": rejected_orders,
        "order_reconciliation": order_reconciliation,
        "repeated_products": repeated_products,
        "skewed_join": skewed_join,
        "stable_customer_keys": stable_customer_keys,
        "stable_product_keys": stable_product_keys,
        "customer_surrogate_key": customer_surrogate_key,
        "product_surrogate_key": product_surrogate_key,
        "valid_customers": valid_customers,
        "valid_customers_strict": strictly(valid_customers),
        "bad_customers": bad_customers,
        "bad_customers_strict": strictly(bad_customers),
        "bad_customers_loader_rule": bad_customers_loader_rule,
        "bad_customer_report": bad_customer_report,
        "bad_customer_report_strict": strictly(bad_customer_report),
        "customer_quarantine_counts": customer_quarantine_counts,
        "customer_quarantine_counts_strict": strictly(customer_quarantine_counts),
        "customers_by_status": customers_by_status,
        "low_profit_orders": low_profit,
        "cast_audit": cast_audit,
        "column_profiles": column_profiles,
        "sanitize_columns": sanitize_columns,
        "scan_orders_json": scan_orders_json,
        "scan_orders_json_array": scan_orders_json_array,
        "scan_products_csv": scan_products_csv,
        "scan_customer_files": scan_customer_files,
        "table_by_path": table_by_path,
        "loaded_view": loaded_view,
        "orders_global_view": orders_global_view,
        "load_row_counts": load_row_counts,
        "ingest_many_files": ingest_many_files,
        "ingest_manifest": ingest_manifest,
        "ingest_file_ledger": ingest_file_ledger,
        "ingest_ledger_outcomes": ingest_ledger_outcomes,
        "schema_evolving_overwrite": schema_evolving_overwrite,
        "batch_profit_agg": batch_profit_agg,
        "batch_customer_status": batch_customer_status,
    }

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` choose the data, the cores and the number
of runs. Each time is the median after one warm-up run, and covers building the query as well
as writing its result to the ``noop`` sink; files that a query reads as its sources are written
beforehand. ``queries`` makes up the metric; ``comparisons`` holds the same work done in two ways.
The operators for training data are timed once after a warm-up, where their folder is present.
"""

from __future__ import annotations

import importlib.util
import json
import logging
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.profit import profit_by_year, with_year
from tallyforge.plans import batch, catalog
from tallyforge.plans.bronze_sample import bronze_customers, bronze_products
from tallyforge.sinks.tables import cluster_by, file_count, overwrite_table, qualified
from tallyforge.workspace import clean_up, scratch_database

HEADLINE = [
    "profit_by_year",
    "profit_by_customer",
    "profit_by_customer_filtered",
    "profit_by_year_customer",
    "profit_by_year_category",
    "profit_by_year_category_filtered",
    "gold_profit_agg",
    "gold_profit_agg_partitioned",
    "gold_orders_count",
    "gold_orders_clustered",
    "enriched_customers",
    "enriched_products",
    "enriched_orders",
    "valid_customers",
    "bad_customers",
    "bad_customer_report",
    "customer_quarantine_counts",
    "low_profit_orders",
    "cast_audit",
    "ingest_many_files",
    "schema_evolving_overwrite",
]

# Those that read source files.
FROM_FILES = [
    "scan_orders_json",
    "scan_orders_json_array",
    "scan_products_csv",
    "scan_customer_files",
    "ingest_manifest",
    "batch_profit_agg",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyforge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "7g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(make: Callable[[], DataFrame | None], runs: int) -> float:
    """Median time of ``make`` and of forcing the frame it returns, if it returns one."""

    def once() -> float:
        start = time.perf_counter()
        result = make()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(runs)), 3)


def comparisons(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame | None]]:
    """Pairs of ways to do the same work, over tables written here beforehand."""
    database = scratch_database(spark)
    overwrite_table(catalog.sanitize_columns(spark, sf_dir), "bronze_orders", database)
    overwrite_table(bronze_products(spark, sf_dir), "bronze_products", database)
    overwrite_table(bronze_customers(spark, sf_dir), "bronze_customer", database)
    batch.build_silver(spark, database)
    batch.build_gold(spark, database)

    def table(name: str) -> DataFrame:
        return spark.table(qualified(name, database))

    lines = batch.enriched_orders(spark, database).repartition(8)
    overwrite_table(lines, "flat_orders", database)
    overwrite_table(table("gold_profit_agg"), "flat_agg", database)
    float_sum = F.round(F.sum("Profit"), 2).alias("Profit")
    row_id = table("gold_orders").agg(F.percentile_approx("Row_ID", 0.5)).first()[0]
    year = table("gold_profit_agg").agg(F.max("Year")).first()[0]

    def clustered(df: DataFrame) -> DataFrame:
        return cluster_by(df, "Row_ID", file_count(spark, 600_000))

    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*order)
    one_window = F.row_number().over(Window.orderBy(*order))
    return {
        "profit_by_year_from_written_aggregate": lambda: profit_by_year(table("gold_profit_agg")),
        "profit_by_year_exact_sum": lambda: profit_by_year(with_year(table("flat_orders"))),
        "profit_by_year_double_sum": lambda: with_year(table("flat_orders")).groupBy("Year").agg(float_sum),
        "clustering_of_written_lines": lambda: clustered(table("flat_orders")),
        "clustering_of_joined_lines": lambda: clustered(batch.enriched_orders(spark, database)),
        "lineitem_key_distributed": lambda: add_dense_key(items, "key", order),
        "lineitem_key_one_window": lambda: items.withColumn("key", one_window),
        "row_id_lookup_clustered": lambda: table("gold_orders").filter(F.col("Row_ID") == row_id),
        "row_id_lookup_unclustered": lambda: table("flat_orders").filter(F.col("Row_ID") == row_id),
        "year_filter_partitioned": lambda: table("gold_profit_agg").filter(F.col("Year") == year),
        "year_filter_flat": lambda: table("flat_agg").filter(F.col("Year") == year),
        "gold_writes_from_written_table": lambda: batch.build_gold(spark, database),
        "gold_writes_from_memory": lambda: batch.build_gold(spark, database, keep_in_memory=True),
    }


def main() -> None:
    logging.getLogger("tallyforge").setLevel(logging.CRITICAL)  # the manifest query fails a file
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    queries = catalog.all_queries()
    folder = catalog.source_files(spark, sf_dir)
    catalog._write_arrays(catalog.order_lines(spark, sf_dir), f"{folder}/Orders_arrays")
    timed = {name: lambda query=queries[name]: query(spark, sf_dir) for name in HEADLINE}
    timed |= {name: lambda query=queries[name]: query(spark, sf_dir, folder) for name in FROM_FILES}
    once = {}
    if importlib.util.find_spec("tallyforge.llm"):
        from tallyforge.llm.queries import all_queries

        once = {name: lambda query=query: query(spark, sf_dir) for name, query in all_queries().items()}
    times = {}
    for name, make in (timed | once).items():
        times[name] = seconds(make, 1 if name in once else runs)
        print(f"{name}: {times[name]}", file=sys.stderr)
    pairs = {name: seconds(make, runs) for name, make in comparisons(spark, sf_dir).items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "comparisons": pairs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    clean_up(spark)
    spark.stop()


if __name__ == "__main__":
    main()

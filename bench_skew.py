"""Build the gold tables from generated order lines of which a third share a customer, a product
and a ``Row_ID``, check them against plain joins and sums, and print one JSON line.

``SKEW_ROWS`` and ``BENCH_CPUS`` choose the number of lines and the cores. Broadcasts are off and
AQE's thresholds are low, so that the joins have to split hot partitions.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import session
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.orders import enrich_order_data
from tallyforge.operators.profit import profit_agg
from tallyforge.sinks.tables import overwrite_clustered, overwrite_partitioned, qualified
from tallyforge.workspace import clean_up, scratch_database


def order_lines(spark: SparkSession, rows: int) -> DataFrame:
    """Columns of the bronze orders; every third line has the hot keys."""
    lines = spark.range(0, rows, 1, 16)
    number = F.col("id")

    def key(prefix: str, others: int):
        return F.when(number % 3 == 0, f"{prefix}0").otherwise(F.concat(F.lit(prefix), (number % others).cast("string")))

    return lines.select(
        key("c", 50_000).alias("Customer_ID"),
        F.lit(0.1).alias("Discount"),
        F.concat_ws("/", F.lit("1"), (number % 12 + 1).cast("string"), (number % 6 + 2015).cast("string")).alias("Order_Date"),
        number.cast("string").alias("Order_ID"),
        F.lit(100.0).alias("Price"),
        key("p", 20_000).alias("Product_ID"),
        (number % 1000 / 100).alias("Profit"),
        F.lit(1).alias("Quantity"),
        F.when(number % 3 == 0, F.lit(7)).otherwise(number).cast("bigint").alias("Row_ID"),
        F.lit("2/1/2020").alias("Ship_Date"),
        F.lit("m").alias("Ship_Mode"),
    )


def dimension(spark: SparkSession, prefix: str, rows: int, *others: str) -> DataFrame:
    name = "Customer_ID" if prefix == "c" else "Product_ID"
    key = F.concat(F.lit(prefix), F.col("id").cast("string")).alias(name)
    return spark.range(rows).select(key, *[F.concat(F.lit(f"{c} "), F.col("id") % 40).alias(c) for c in others])


def main() -> None:
    rows = int(os.environ.get("SKEW_ROWS", "6000000"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8m")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    database = scratch_database(spark)
    lines = order_lines(spark, rows)
    customers = dimension(spark, "c", 50_000, "Customer_Name", "Country")
    products = dimension(spark, "p", 20_000, "Category", "Sub_Category")

    start = time.perf_counter()
    overwrite_clustered(enrich_order_data(lines, customers, products), "gold_orders", "Row_ID", database, partitions=64)
    written = spark.table(qualified("gold_orders", database))
    overwrite_partitioned(profit_agg(written), "gold_profit_agg", "Year", database)
    seconds = {"gold": time.perf_counter() - start}
    files = written.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.count_if(F.col("Row_ID") == 7).alias("hot")
    )
    largest, hot_files, count = files.agg(F.max("n"), F.count_if(F.col("hot") > 0), F.sum("n")).first()
    total = spark.table(qualified("gold_profit_agg", database)).agg(F.round(F.sum("Profit"), 2)).first()[0]
    cents = lines.agg(F.sum(F.round(F.col("Profit") * 100).cast("bigint"))).first()[0]
    assert count == rows and total == cents / 100

    frames = {
        "unique_keys": spark.range(0, rows, 1, 16).select(F.col("id").cast("string").alias("k")),
        "hot_value": lines.select(F.col("Customer_ID").alias("k"), "Order_ID"),
        "hot_copies": lines.select(F.col("Row_ID").alias("k")),
    }
    for name, frame in frames.items():
        start = time.perf_counter()
        highest, n = add_dense_key(frame, "pk", ["k"]).agg(F.max("pk"), F.count_distinct("pk")).first()
        seconds[f"dense_key_{name}"] = time.perf_counter() - start
        assert highest == n == rows
    print(
        json.dumps(
            {
                "rows": rows,
                "cpus": int(cpus),
                "seconds": {k: round(v, 1) for k, v in seconds.items()},
                "largest_file": largest,
                "files_with_hot_row_id": hot_files,
            }
        )
    )
    clean_up(spark)
    spark.stop()


if __name__ == "__main__":
    main()

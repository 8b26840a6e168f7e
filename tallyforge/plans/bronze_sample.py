"""The three bronze frames, shaped from the test tables by narrow projections and key joins.

The test tables have no e-mail, phone or address, and their customer names are not clean, so
these are derived from the keys. The derivation plants every kind of bad value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.schemas import ORDERS_FILE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("c_custkey") % n == 0


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = _table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey").cast("string")
    letters = F.translate(F.expr("substr(c_name, 10)"), "0123456789", "abcdefghij")
    name = (
        F.when(_every(23), F.col("c_name"))
        .when(_every(29), F.lit(None))
        .when(_every(31), F.concat(F.lit("O'Brien_"), letters))
        .when(_every(37), F.lit("Shared-Name"))
        .when(_every(41), F.lit("Ann 2"))
        .otherwise(F.concat(F.lit("  Customer "), letters, F.lit(". ")))
    )
    phone = (
        F.when(_every(11), F.concat(F.lit("-"), key))
        .when(_every(13), F.lit("#ERROR!"))
        .when(_every(17), F.lit(None))
        .otherwise(F.concat(F.lit("555."), key))
    )
    address = F.when(_every(7), F.concat(F.lit("Box "), key)).otherwise(
        F.concat(key, F.lit(" Main St, Apt "), F.col("c_nationkey").cast("string"))
    )
    return rows.select(
        key.alias("Customer_ID"),
        name.alias("Customer_Name"),
        F.concat(F.lit("c"), key, F.lit("@example.com")).alias("Email"),
        phone.alias("Phone"),
        address.alias("Address"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("n_name").alias("Country"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("State"),
        F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(key).alias("Postal_Code"),
        F.col("r_name").alias("Region"),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Product_ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub_Category"),
        F.col("p_name").alias("Product_Name"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the column names of an order file, spaces included."""
    # What belongs to the order is shaped before the join, once per order and not per line.
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.date_format(F.col("o_orderdate").cast("date"), "d/M/yyyy").alias("ordered"),
        "o_orderpriority",
    )
    rows = _table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    margin = F.lit("0.20").cast("decimal(4,2)") - F.lit(4) * F.col("l_discount").cast("decimal(4,2)")
    columns = {
        "Customer ID": F.col("customer"),
        "Discount": F.col("l_discount"),
        "Order Date": F.col("ordered"),
        "Order ID": F.col("l_orderkey").cast("string"),
        "Price": price.cast("double"),
        "Product ID": F.col("l_partkey").cast("string"),
        "Profit": (price * margin).cast("double"),
        "Quantity": F.col("l_quantity").cast("int"),
        "Row ID": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint"),
        "Ship Date": F.date_format(F.col("l_shipdate").cast("date"), "d/M/yyyy"),
        "Ship Mode": F.col("o_orderpriority"),
    }
    return rows.select(*[columns[name].alias(name) for name in ORDERS_FILE])

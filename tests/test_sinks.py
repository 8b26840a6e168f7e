"""Overwrites, layout, and the whole batch."""

import json

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.customers import bad_customers, enrich_customer_data, valid_customers
from tallyforge.operators.orders import enrich_order_data
from tallyforge.operators.profit import profit_agg, profit_by_customer, profit_by_year_category
from tallyforge.plans import batch, catalog
from tallyforge.plans.bronze_sample import bronze_customers, bronze_products, order_lines
from tallyforge.plans.catalog import _write_csv
from tallyforge.schemas import GOLD_ORDERS, GOLD_PROFIT_AGG
from tallyforge.sinks.tables import (
    cluster_by,
    overwrite_clustered,
    overwrite_partitioned,
    overwrite_table,
    reused,
)
from tallyforge.workspace import shared_folder

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_overwrite_keeps_and_adds_columns(spark, database):
    overwrite_table(spark.createDataFrame([(1, "x")], "a int, b string"), "t", database)
    overwrite_table(spark.createDataFrame([(2.5, 7)], "c double, A int"), "t", database)
    table = spark.table(f"{database}.t")
    assert table.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert rows(table) == [(7, None, 2.5)]


def test_overwrite_rejects_another_type(spark, database):
    overwrite_table(spark.createDataFrame([(1, "x")], "a int, b string"), "t", database)
    with pytest.raises(ValueError, match="a: int in the table, string in the data"):
        overwrite_table(spark.createDataFrame([("1",)], "a string"), "t", database)
    assert rows(spark.table(f"{database}.t")) == [(1, "x")]
    overwrite_table(spark.createDataFrame([("1",)], "a string"), "t", database, merge_schema=False)
    assert spark.table(f"{database}.t").dtypes == [("a", "string")]


def test_partitions_keep_type_and_null(spark, database):
    df = spark.createDataFrame([(2019, 1.0), (2020, 2.0), (None, 3.0)], "Year int, Profit double")
    overwrite_partitioned(df, "t", "Year", database)
    table = spark.table(f"{database}.t")
    assert dict(table.dtypes)["Year"] == "int"
    assert {(r.Year, r.Profit) for r in table.collect()} == {(2019, 1.0), (2020, 2.0), (None, 3.0)}
    overwrite_partitioned(df.filter("Year = 2020"), "t", "Year", database)
    assert spark.table(f"{database}.t").count() == 1


def test_year_filter_prunes_and_category_filter_is_pushed(spark, database):
    overwrite_partitioned(catalog.gold_profit_agg(spark, SF_DIR), "agg", "Year", database)
    table = spark.table(f"{database}.agg")
    plan = executed(table.filter("Year = 1997"))
    assert "PartitionFilters: [isnotnull(Year" in plan
    plan = executed(profit_by_year_category(table, "ECONOMY"))
    assert "EqualTo(Category,ECONOMY)" in plan
    plan = executed(profit_by_customer(table, "SharedName"))
    assert "EqualTo(Customer_Name,SharedName)" in plan
    assert "EqualTo(Customer_Name,SharedName)" in executed(catalog.profit_by_customer_filtered(spark, SF_DIR))
    assert "EqualTo(Category,ECONOMY)" in executed(catalog.profit_by_year_category_filtered(spark, SF_DIR))
    detail = catalog.profit_detail(spark, SF_DIR).filter("Year = 1997")
    assert "PartitionFilters: [isnotnull(Year" in executed(detail)


def test_a_big_partition_value_is_split_over_files(spark, database):
    # A small value whose hash partition also holds a big one is split along with it, so the
    # values need enough partitions to be apart, as they have on a cluster.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        year = F.when(F.col("id") % 3 == 0, 2020).otherwise((F.col("id") % 20).cast("int"))
        df = spark.range(0, 40_000, 1, 8).select(year.alias("Year"), F.rand(1).alias("Profit"))
        overwrite_partitioned(df, "t", "Year", database)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    table = spark.table(f"{database}.t")
    located = table.select("Year", F.input_file_name().alias("file"))
    files = {r.Year: r.n for r in located.groupBy("Year").agg(F.count_distinct("file").alias("n")).collect()}
    assert table.count() == 40_000
    assert files.pop(2020) >= 3
    assert max(files.values()) <= 3


def file_ranges(table, column):
    found = table.groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return [(r.lo, r.hi) for r in found.orderBy("lo", "hi").collect()]


def test_clustered_files_cover_separate_ranges(spark, database):
    df = catalog.enriched_orders(spark, "/root/testdata/sf0.01")
    overwrite_clustered(df, "t", "Row_ID", database, partitions=6)
    ranges = file_ranges(spark.table(f"{database}.t"), "Row_ID")
    assert len(ranges) == 6
    # Row_ID repeats in the test data, so neighbours may share the value at their border.
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_hot_values_and_copies_do_not_fill_one_file(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id").cast("int"))
    for other in (F.col("id"), F.lit(0)):  # different rows, then copies
        df = spark.range(0, 24_000, 1, 8).select(hot.alias("k"), other.alias("v"))
        parts = cluster_by(df, "k", partitions=8).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in parts.collect()]
        assert sum(sizes) == 24_000 and max(sizes) < 6_000


def test_only_a_hot_value_is_shared_between_ranges(spark):
    hot = F.when(F.col("id") % 2 == 0, F.lit(5_000)).otherwise(F.col("id").cast("int"))
    df = spark.range(0, 20_000, 1, 4).select(hot.alias("k"), F.col("id"))
    placed = cluster_by(df, "k", partitions=10)
    spans = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    spans = [(r.lo, r.hi) for r in spans.orderBy("p").collect()]
    assert sum(lo <= 5_000 <= hi for lo, hi in spans) >= 4
    assert all(a[1] < b[0] or a[1] == b[0] == 5_000 for a, b in zip(spans, spans[1:]))


def test_clustering_keeps_nulls_and_every_row(spark, database):
    k = F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 10_007).cast("int"))
    df = spark.range(10_000).select(k.alias("k"), "id")
    overwrite_clustered(df, "t", "k", database, partitions=12)
    table = spark.table(f"{database}.t")
    assert rows(table.select("id")) == [(i,) for i in range(10_000)]
    values = file_ranges(table.filter("k IS NOT NULL"), "k")
    assert len(values) >= 8 and all(a[1] < b[0] for a, b in zip(values, values[1:]))


def test_clustering_an_empty_frame(spark, database):
    overwrite_clustered(spark.createDataFrame([], "k int, v string"), "t", "k", database)
    assert spark.table(f"{database}.t").count() == 0


def test_joins_below_a_clustered_write_run_once(spark, database):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 5_000, 1, 4).mapInArrow(count, "id bigint")
    overwrite_clustered(df, "t", "id", database, partitions=5)
    assert spark.table(f"{database}.t").count() == seen.value == 5_000


def test_reused_frame_is_released(spark):
    df = spark.range(10)
    with reused(df) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not df.is_cached


def test_shared_folder_follows_the_session(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark)


# --- batch --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def source_files(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("in"))
    order_lines(spark, SF_DIR).write.json(f"{folder}/Orders.json")
    _write_csv(bronze_products(spark, SF_DIR), f"{folder}/Products.csv")
    _write_csv(bronze_customers(spark, SF_DIR), f"{folder}/Customer.csv")
    return [f"{folder}/{name}" for name in ("Customer.csv", "Orders.json", "Products.csv")]


@pytest.mark.parametrize("strict", [False, True])
def test_batch(spark, database, source_files, strict):
    manifest = batch.run_batch(spark, source_files, database, strict=strict)
    assert [r.status for r in manifest.collect()] == ["loaded"] * 3

    def table(name):
        return spark.table(f"{database}.{name}")

    customers = enrich_customer_data(bronze_customers(spark, SF_DIR), strict)
    expected = enrich_order_data(
        table("bronze_orders"), valid_customers(customers), bronze_products(spark, SF_DIR)
    )
    assert rows(table("silver_customer")) == rows(valid_customers(customers))
    assert table("bad_silver_customer").count() == bad_customers(customers).count() > 0
    split = [table(name).count() for name, _ in batch.CUSTOMER_TABLES.values()]
    assert sum(split) == table("bronze_customer").count() and all(split)
    assert rows(table("silver_products")) == rows(catalog.enriched_products(spark, SF_DIR))
    assert dict(table("gold_orders").dtypes) == GOLD_ORDERS
    assert rows(table("gold_orders")) == rows(expected)
    assert dict(table("gold_profit_agg").dtypes) == GOLD_PROFIT_AGG
    assert rows(table("gold_profit_agg").select(*GOLD_PROFIT_AGG)) == rows(profit_agg(expected))
    assert spark.table("global_temp.enriched_ord_df").count() == table("gold_orders").count()
    by_sql = spark.sql(
        f"SELECT Year, round(sum(Profit), 2) AS Profit FROM {database}.gold_profit_agg GROUP BY Year ORDER BY Year"
    )
    assert [r.Year for r in by_sql.collect()] == sorted({r.Year for r in expected.select(F.year("Order_Date").alias("Year")).collect()})


def test_batch_can_run_again_and_in_memory(spark, database, source_files):
    batch.run_batch(spark, source_files, database, broadcast_limit=None)
    first = rows(spark.table(f"{database}.gold_profit_agg"))
    batch.run_batch(spark, source_files, database)
    assert rows(spark.table(f"{database}.gold_profit_agg")) == first
    batch.build_gold(spark, database, keep_in_memory=True)
    assert rows(spark.table(f"{database}.gold_profit_agg")) == first


def test_batch_stops_when_a_source_is_bad(spark, database, source_files, tmp_path):
    bad = tmp_path / "Customer.xlsx"
    bad.write_bytes(b"broken")
    with pytest.raises(RuntimeError, match="Customer.xlsx"):
        batch.run_batch(spark, [str(bad), *source_files[1:]], database)


def test_batch_needs_every_source_of_its_own(spark, database, source_files, tmp_path):
    batch.run_batch(spark, source_files, database)
    before = rows(spark.table(f"{database}.gold_orders"))
    misnamed = tmp_path / "customer_new.csv"
    misnamed.write_text("x\n")
    with pytest.raises(RuntimeError, match="no source for .*bronze_customer.*customer_new.csv"):
        batch.run_batch(spark, [str(misnamed), source_files[1]], database)
    batch.run_batch(spark, source_files[1:2], database, allow_existing=True)
    assert rows(spark.table(f"{database}.gold_orders")) == before


def test_two_batches_have_views_of_their_own(spark, database, source_files):
    batch.run_batch(spark, source_files, database, orders_view="first_orders")
    assert spark.table("global_temp.first_orders").count() == spark.table(f"{database}.gold_orders").count()


def test_array_order_file(spark, database, source_files, tmp_path):
    lines = [json.loads(s) for s in order_lines(spark, SF_DIR).limit(50).toJSON().collect()]
    path = tmp_path / "Orders.json"
    path.write_text(json.dumps(lines))
    manifest = batch.run_batch(spark, [source_files[0], str(path), source_files[2]], database)
    assert {r.table_name: r.row_count for r in manifest.collect()}["bronze_orders"] == 50

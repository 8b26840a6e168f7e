"""Dense keys against the one-task row_number they replace."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge import workspace
from tallyforge.operators import keys
from tallyforge.operators.customers import enrich_customer_data
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.products import enrich_product_data
from tallyforge.schemas import CUSTOMERS, PRODUCTS, SILVER_PRODUCT, ddl


def literal(df, name, order_by):
    w = Window.orderBy(*order_by, F.xxhash64(*df.columns), *df.columns)
    return df.select(F.row_number().over(w).alias(name), *df.columns)


def assert_same(df, order_by, **options):
    got = Counter(tuple(r) for r in add_dense_key(df, "pk", order_by, **options).collect())
    assert got == Counter(tuple(r) for r in literal(df, "pk", order_by).collect())


def test_unique_text_keys(spark):
    df = spark.range(20_000).select(F.concat(F.lit("K-"), F.col("id").cast("string")).alias("k"), "id")
    assert_same(df, ["k"], partitions=60)


def test_many_ranges_search(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_003).alias("k"))
    assert_same(df, ["k"], partitions=300)


def test_nulls_come_first(spark):
    k = F.when(F.col("id") % 10 != 0, F.col("id").cast("string"))
    df = spark.range(10_000).select(k.alias("k"), "id")
    assert_same(df, ["k"], partitions=40)
    first = add_dense_key(df, "pk", ["k"], partitions=40).filter("k IS NULL")
    assert first.agg(F.max("pk")).first()[0] == 1_000


def largest_task(df, order_by, partitions):
    """Most rows that one task sorts, with partitions kept apart."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        add_dense_key(df, "pk", order_by, partitions=partitions)
        written = spark.read.parquet(workspace._folders[-1])
        sizes = written.groupBy(F.shiftright("_place", keys.PLACE_BITS)).agg(F.count("*").alias("n"))
        return sizes.agg(F.max("n")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_value_is_spread(spark):
    k = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(30_000).select(k.alias("k"), "id")
    assert_same(df, ["k"], partitions=60)
    assert largest_task(df, ["k"], 60) < 2_500


def test_hot_null_value(spark):
    k = F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))
    df = spark.range(20_000).select(k.alias("k"), "id")
    assert_same(df, ["k"], partitions=40)
    assert largest_task(df, ["k"], 40) < 2_500


def test_hot_copies_are_spread(spark):
    k = F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, 30_000, 1, 8).select(k.alias("k"), F.lit("x").alias("v"))
    assert_same(df, ["k"], partitions=60)
    assert largest_task(df, ["k"], 60) < 2_500


def test_input_is_read_twice_at_most(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 10_000, 1, 4).mapInArrow(count, "id bigint")
    keyed = add_dense_key(df, "pk", ["id"], partitions=20)
    assert keyed.agg(F.max("pk")).first()[0] == keyed.count() == 10_000
    assert seen.value <= 20_000


def test_several_order_columns_and_types(spark):
    df = spark.range(6_000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d"),
        (F.col("id") % 7).cast("double").alias("x"),
        "id",
    )
    assert_same(df, ["d", "x"], partitions=50)


@pytest.mark.parametrize("rows", [0, 1, 3])
def test_few_rows(spark, rows):
    assert_same(spark.range(rows).select(F.col("id").cast("string").alias("k")), ["k"])


def test_key_type(spark, monkeypatch):
    df = spark.range(100).select("id")
    assert dict(add_dense_key(df, "pk", ["id"]).dtypes)["pk"] == "int"
    monkeypatch.setattr(keys, "INT_MAX", 99)
    with pytest.raises(ValueError, match="bigint"):
        add_dense_key(df, "pk", ["id"])
    assert dict(add_dense_key(df, "pk", ["id"], key_type="bigint").dtypes)["pk"] == "bigint"


def test_no_task_sorts_the_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber"]
    assert largest_task(df, order, 40) < 60_000 / 8
    keyed = add_dense_key(df, "pk", order, partitions=40)
    assert keyed.agg(F.min("pk"), F.max("pk"), F.count_distinct("pk")).first() == (1, 60_000, 60_000)


def test_key_type_of_the_dimensions(spark):
    rows = spark.createDataFrame([("b", "c", "s", "n")], ddl(PRODUCTS))
    assert dict(enrich_product_data(rows, key_type="bigint").dtypes)["Product_PK"] == "bigint"
    people = spark.createDataFrame([tuple("abcdefghijk")], ddl(CUSTOMERS))
    assert dict(enrich_customer_data(people, key_type="bigint").dtypes)["Customer_PK"] == "bigint"


def test_products(spark):
    rows = [("b", "c", "s", "n"), ("a", "c", "s", "n"), (None, None, None, None)]
    enriched = enrich_product_data(spark.createDataFrame(rows, ddl(PRODUCTS)))
    assert dict(enriched.dtypes) == SILVER_PRODUCT
    assert {r.Product_ID: r.Product_PK for r in enriched.collect()} == {None: 1, "a": 2, "b": 3}

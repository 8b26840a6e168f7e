"""Order refinement, the enriching joins, profit totals and their plans."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.money import money_sum
from tallyforge.operators.columns import sanitize_cols, type_mismatches
from tallyforge.operators.joins import join_dimension, row_bytes
from tallyforge.operators.orders import enrich_order_data, low_profit_orders, refine_orders
from tallyforge.operators.profit import profit_agg, profit_by_year, profit_by_year_customer, with_year
from tallyforge.operators.quality import cast_audit
from tallyforge.plans import catalog
from tallyforge.schemas import CUSTOMERS, GOLD_ORDERS, GOLD_PROFIT_AGG, ORDERS_FILE, PRODUCTS, ddl

SF_DIR = "/root/testdata/sf0.001"


def orders(spark, rows):
    """Order lines from (row id, customer, product, order date, price, profit)."""
    full = [(c, 0.1, d, "o", price, p, profit, 1, i, "1/2/2020", "First") for i, c, p, d, price, profit in rows]
    return sanitize_cols(spark.createDataFrame(full, ddl(ORDERS_FILE)))


def dimensions(spark, customer_ids, product_ids):
    customers = spark.createDataFrame(
        [(c, f"Name {c}", "Land") for c in customer_ids], "Customer_ID string, Customer_Name string, Country string"
    )
    products = spark.createDataFrame([(p, "Cat", "Sub", "n") for p in product_ids], ddl(PRODUCTS))
    return customers, products


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_and_profit(spark, ansi):
    texts = ["21/8/2016", "21/08/2016", "1/1/2020", "2016-08-21", "31/2/2017", "21/8/16", "", None]
    rows = [(i, "c", "p", text, 1.0, 1.005) for i, text in enumerate(texts)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    got = refine_orders(orders(spark, rows)).orderBy("Row_ID").collect()
    spark.conf.set("spark.sql.ansi.enabled", "true")
    day = datetime.date(2016, 8, 21)
    assert [r.Order_Date for r in got] == [day, day, datetime.date(2020, 1, 1)] + [None] * 5
    assert {r.Ship_Date for r in got} == {datetime.date(2020, 2, 1)}
    assert {r.Profit for r in got} == {1.01}


def test_profit_rounds_half_away_from_zero(spark):
    values = [0.125, -0.125, 2.675, -2.675, 0.004, None]
    rows = [(i, "c", "p", None, 1.0, v) for i, v in enumerate(values)]
    got = [r.Profit for r in refine_orders(orders(spark, rows)).orderBy("Row_ID").collect()]
    assert got == [0.13, -0.13, 2.68, -2.68, 0.0, None]


@pytest.mark.parametrize("limit", [None, 1 << 20, 1])
def test_join_rules(spark, limit):
    lines = orders(
        spark,
        [
            (1, "c1", "p1", "1/1/2020", 1.0, 1.0),
            (2, "unknown", "p1", "1/1/2020", 1.0, 1.0),
            (3, "c1", "unknown", "1/1/2020", 1.0, 1.0),
            (4, None, "p1", "1/1/2020", 1.0, 1.0),
            (5, "c2", "p2", "1/1/2020", 1.0, 1.0),
        ],
    )
    customers, products = dimensions(spark, ["c1", "c2", None], ["p1", "p2", "p2", None])
    got = enrich_order_data(lines, customers, products, broadcast_limit=limit)
    assert dict(got.dtypes) == GOLD_ORDERS
    assert got.columns == list(GOLD_ORDERS)
    assert sorted(r.Row_ID for r in got.collect()) == [1, 5, 5]


def test_missing_dimension_column_is_named(spark):
    customers, products = dimensions(spark, ["c"], ["p"])
    with pytest.raises(ValueError, match="products lacks.*Sub_Category"):
        enrich_order_data(orders(spark, []), customers, products.drop("Sub_Category"))


def test_low_profit_drops_zero_price(spark, ansi_off):
    enriched = spark.createDataFrame(
        [("a", 10.0, 0.5), ("b", 10.0, 1.0), ("c", 0.0, 1.0), ("d", None, 1.0), ("e", 8.0, -8.0)],
        "Customer_Name string, Price double, Profit double",
    )
    expected = {("a", 5.0), ("e", -100.0)}
    assert {tuple(r) for r in low_profit_orders(enriched).collect()} == expected
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert {tuple(r) for r in low_profit_orders(enriched).collect()} == expected


def test_money_sum_is_exact_and_order_independent(spark):
    df = spark.range(0, 100_000, 1, 16).select((F.col("id") % 1000 / 100).alias("x"))
    assert df.agg(money_sum(F.col("x"))).first()[0] == 499_500.0
    assert spark.createDataFrame([(1.15,), (-0.07,)], "x double").agg(money_sum(F.col("x"))).first()[0] == 1.08


@pytest.mark.parametrize(
    "values, expected",
    [
        ([None, None], None),
        ([1.5, None], 1.5),
        ([9e16, 9e16], 1.8e17),
        ([0.004] * 1000, 4.0),
        ([0.1] * 10, 1.0),
        ([1e17, 0.01, -1e17], 0.01),
        ([math.inf, 1.0], math.inf),
        ([-math.inf, 1.0], -math.inf),
    ],
)
def test_money_sum_edges(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_out_of_range_raise(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for amount in (1e300, -1e18):
            with pytest.raises(Exception, match="amount out of range"):
                spark.createDataFrame([(amount,)], "x double").agg(money_sum(F.col("x"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_reports_do_not_round_single_amounts(spark):
    lines = spark.createDataFrame([(2020, "c", "s", "n", 0.004)] * 1000, ddl(GOLD_PROFIT_AGG))
    assert [tuple(r) for r in profit_by_year(lines).collect()] == [(2020, 4.0)]


def test_money_sum_of_nan(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,)], "x double")
    assert math.isnan(df.agg(money_sum(F.col("x"))).first()[0])


def test_profit_totals_keep_unknown_year_and_merge_namesakes(spark):
    lines = orders(
        spark,
        [
            (1, "c1", "p", "1/1/2020", 1.0, 1.11),
            (2, "c2", "p", "2/1/2020", 1.0, 2.22),
            (3, "c1", "p", "not a date", 1.0, 4.0),
        ],
    )
    customers, products = dimensions(spark, ["c1", "c2"], ["p"])
    enriched = enrich_order_data(lines, customers.withColumn("Customer_Name", F.lit("Same")), products)
    agg = profit_agg(enriched)
    assert dict(agg.dtypes) == GOLD_PROFIT_AGG
    assert {(r.Year, r.Profit) for r in agg.collect()} == {(2020, 3.33), (None, 4.0)}
    assert [tuple(r) for r in profit_by_year(agg).collect()] == [(None, 4.0), (2020, 3.33)]


def test_totals_agree_between_layers(spark):
    enriched = catalog.enriched_orders(spark, SF_DIR).persist()
    total = enriched.agg(money_sum(F.col("Profit"))).first()[0]
    agg = profit_agg(enriched)
    assert agg.agg(money_sum(F.col("Profit"))).first()[0] == total
    assert profit_by_year(agg).collect() == profit_by_year(with_year(enriched)).collect()
    assert profit_by_year_customer(agg).collect() == profit_by_year_customer(with_year(enriched)).collect()
    enriched.unpersist()


def test_cast_audit(spark):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "z")], "`a b` string, c string")
    got = [tuple(r) for r in cast_audit(df, {"a b": "int", "c": "date"}).collect()]
    assert got == [("a b", "int", 1), ("c", "date", 2)]


def test_type_mismatches(spark):
    df = spark.createDataFrame([], ddl(PRODUCTS))
    assert type_mismatches(df, PRODUCTS) == []
    as_int = df.select(*[F.col(c).cast("int") for c in df.columns])
    assert type_mismatches(as_int, PRODUCTS) == [(c, "int", "string") for c in PRODUCTS]


def test_sanitize(spark):
    df = spark.createDataFrame([], "` A-B ` int, `Sub-Category x` int, plain int")
    assert sanitize_cols(df).columns == ["_A_B_", "Sub_Category_x", "plain"]
    with pytest.raises(ValueError, match="A B.*A-B"):
        sanitize_cols(spark.createDataFrame([], "`A B` int, `A-B` int"))
    with pytest.raises(ValueError, match="same name"):
        sanitize_cols(spark.createDataFrame([], "`a b` int, A_B int"))


# --- plans --------------------------------------------------------------------------------


def test_surrogate_keys_stay_out_of_the_join_plan(spark):
    plan = executed(catalog.enriched_orders(spark, SF_DIR))
    assert "Window" not in plan and "SinglePartition" not in plan


def test_report_reads_only_the_columns_it_needs(spark):
    plan = executed(catalog.profit_by_year(spark, SF_DIR))
    assert "l_shipdate" not in plan and "l_quantity" not in plan and "o_orderpriority" not in plan


def test_report_shuffles_years_only(spark):
    """No exchange on the four keys of the aggregate: lines are combined straight into years."""
    plan = executed(catalog.profit_by_year(spark, SF_DIR))
    assert "hashpartitioning(Year" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "Sub_Category" in line]


def test_measured_size_decides_on_the_broadcast(spark):
    fact = spark.range(1_000).select((F.col("id") % 10).cast("string").alias("k"))
    dimension = spark.range(1_000).select(F.col("id").cast("string").alias("k"))
    size = row_bytes(dimension)
    assert 1_000 * 24 < size < 1_000 * 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
    try:
        assert "BroadcastHashJoin" in executed(join_dimension(fact, dimension, "k", size))
        assert "BroadcastHashJoin" not in executed(join_dimension(fact, dimension, "k", size - 1))
        assert "BroadcastHashJoin" not in executed(join_dimension(fact, dimension, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_without_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("c0")).otherwise(F.concat(F.lit("c"), F.col("id") % 500))
        lines = spark.range(0, 60_000, 1, 16).select(
            key.alias("Customer_ID"), F.lit("p").alias("Product_ID"), F.lit("1/1/2020").alias("Order_Date"),
            F.lit("1/1/2020").alias("Ship_Date"), F.lit(1.0).alias("Profit"), F.lit(2.0).alias("Price"),
            F.lit(0.0).alias("Discount"), F.lit("m").alias("Ship_Mode"), F.col("id").cast("int").alias("Row_ID"),
            F.lit("o").alias("Order_ID"), F.lit(1).alias("Quantity"),
        )
        customers, products = dimensions(spark, [f"c{i}" for i in range(500)], ["p"])
        joined = enrich_order_data(lines, customers, products)
        assert joined.agg(F.count("*"), F.count_distinct("Row_ID")).first() == (60_000, 60_000)
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in executed(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_customer_columns_cover_the_file_schema():
    assert list(CUSTOMERS)[:5] == ["Customer_ID", "Customer_Name", "Email", "Phone", "Address"]

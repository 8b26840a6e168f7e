"""Incremental aggregates against full rebuilds, stable keys, rejected lines, joins with hot keys."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import registry as reg
from tallyforge.operators import rejects, skew
from tallyforge.operators.joins import join_dimension
from tallyforge.operators.profit import profit_agg
from tallyforge.plans import batch, catalog
from tallyforge.plans.refresh import change_orders, refresh_profit_agg
from tallyforge.schemas import GOLD_ORDERS, ddl
from tallyforge.sinks.publish import property_of, rollback
from tallyforge.sinks.tables import overwrite_clustered, overwrite_partitioned

SF_DIR = "/root/testdata/sf0.001"


# --- incremental aggregate -----------------------------------------------------------------


def line(row_id, date, profit=1.0, customer="A", category="c"):
    return (row_id, "o", date, date, "m", 1, 10.0, 0.0, profit, customer, "x", category, "s")


def lines(spark, *rows):
    df = spark.createDataFrame([tuple(None if i in (2, 3) else v for i, v in enumerate(r)) for r in rows], ddl(GOLD_ORDERS))
    dates = spark.createDataFrame([(r[0], r[2]) for r in rows], "Row_ID bigint, d string")
    joined = df.drop("Order_Date", "Ship_Date").join(dates, df.Row_ID.eqNullSafe(dates.Row_ID)).drop(dates.Row_ID)
    return joined.withColumns({c: F.to_date("d") for c in ("Order_Date", "Ship_Date")}).select(*GOLD_ORDERS)


def build(spark, database, df):
    overwrite_clustered(df, "gold_orders", "Row_ID", database)
    overwrite_partitioned(profit_agg(spark.table(f"{database}.gold_orders")), "gold_profit_agg", "Year", database)


def agg(spark, database):
    return Counter(map(tuple, spark.table(f"{database}.gold_profit_agg").select("Year", "Category", "Customer_Name", "Profit").collect()))


def rebuilt(spark, database):
    full = profit_agg(spark.table(f"{database}.gold_orders"))
    return Counter(map(tuple, full.select("Year", "Category", "Customer_Name", "Profit").collect()))


def files_of(spark, database):
    found = {}
    for path in spark.table(f"{database}.gold_profit_agg").inputFiles():
        path = path.removeprefix("file://")
        year = path.rsplit("Year=", 1)[1].split("/")[0]
        found.setdefault(year, set()).add((path, os.stat(path).st_mtime_ns, os.stat(path).st_ino))
    return found


def test_only_touched_years_are_built_anew(spark, database):
    build(spark, database, lines(spark, line(1, "2015-01-02"), line(2, "2015-03-04"), line(3, "2016-01-01"), line(4, "2017-01-01"), line(5, None), line(6, "2018-01-01")))
    before = files_of(spark, database)
    # One corrected within its year, one moved to another, one into a new year, one of no year, one added.
    changed = lines(spark, line(2, "2015-03-04", 7.5), line(4, "2016-05-05"), line(7, "2020-01-01"), line(8, None, 2.0))
    years = change_orders(spark, changed, database)
    assert years == [None, 2015, 2016, 2017, 2020]
    refresh_profit_agg(spark, years, database)
    assert agg(spark, database) == rebuilt(spark, database)
    assert Counter({(r[0]): 1 for r in agg(spark, database)}) == Counter([None, 2015, 2016, 2018, 2020])
    after = files_of(spark, database)
    assert after["2018"] == before["2018"] and after["2015"] != before["2015"] and "2017" not in after
    # Lines may also just go away.
    years = change_orders(spark, changed.limit(0), database, removed=spark.createDataFrame([(5,), (8,), (6,)], "Row_ID bigint"))
    refresh_profit_agg(spark, years, database)
    assert agg(spark, database) == rebuilt(spark, database) and set(files_of(spark, database)) == {"2015", "2016", "2020"}
    refresh_profit_agg(spark, [], database)
    assert agg(spark, database) == rebuilt(spark, database)


def test_failed_refresh_changes_nothing(spark, database, monkeypatch):
    build(spark, database, lines(spark, line(1, "2015-01-02"), line(2, "2016-03-04")))
    before = files_of(spark, database)
    from tallyforge.plans import refresh

    def broken(df):
        return profit_agg(df).withColumn("Profit", F.raise_error(F.lit("no profit")).cast("double"))

    monkeypatch.setattr(refresh, "profit_agg", broken)
    with pytest.raises(Exception, match="no profit"):
        refresh_profit_agg(spark, [2015, 2016], database)
    assert files_of(spark, database) == before


def test_session_keeps_its_settings(spark, database):
    build(spark, database, lines(spark, line(1, "2015-01-02")))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    refresh_profit_agg(spark, [2015], database)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


# --- stable keys -----------------------------------------------------------------------------


def ids(spark, *values):
    return spark.createDataFrame([(v, 1) for v in values], "id string, name int")


def keys(df):
    return {(r.id, r.k) for r in df.collect()}


def test_keys_stay(spark, database):
    first = reg.add_registered_key(ids(spark, "b", "d", None, "b"), "k", "id", "t", database)
    assert Counter((r.id, r.k, r.name) for r in first.collect()) == Counter([(None, 1, 1), ("b", 2, 1), ("b", 2, 1), ("d", 3, 1)])
    assert first.dtypes == [("k", "int"), ("id", "string"), ("name", "int")]
    second = reg.add_registered_key(ids(spark, "a", "d", "c"), "k", "id", "t", database)
    assert keys(second) == {("a", 4), ("c", 5), ("d", 3)}
    assert keys(reg.add_registered_key(ids(spark, "b", None), "k", "id", "t", database)) == {("b", 2), (None, 1)}
    assert keys(reg.registry(spark, "t", database)) == {(None, 1), ("b", 2), ("d", 3), ("a", 4), ("c", 5)}
    assert property_of(spark, "t", "load", database) == "2"  # a run without a new id writes none


def test_empty_and_other_registries(spark, database):
    assert reg.registry(spark, "t", database) is None
    assert reg.add_registered_key(ids(spark), "k", "id", "t", database).collect() == []
    assert keys(reg.add_registered_key(ids(spark, "x"), "k", "id", "t", database)) == {("x", 1)}
    assert keys(reg.add_registered_key(ids(spark, "y"), "k", "id", "u", database)) == {("y", 1)}


def test_interrupted_run_gives_no_key(spark, database, monkeypatch):
    reg.add_registered_key(ids(spark, "a"), "k", "id", "t", database)

    def lost(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(reg, "switch_to", lost)
        with pytest.raises(KeyboardInterrupt):
            reg.register(ids(spark, "b"), "k", "id", "t", database)
    assert keys(reg.registry(spark, "t", database)) == {("a", 1)}
    assert keys(reg.register(ids(spark, "c", "b"), "k", "id", "t", database)) == {("a", 1), ("b", 2), ("c", 3)}


def test_keys_above_int(spark, database, monkeypatch):
    monkeypatch.setattr(reg, "INT_MAX", 2)
    with pytest.raises(ValueError, match="3 ids need a bigint k"):
        reg.register(ids(spark, "a", "b", "c"), "k", "id", "t", database)
    found = reg.register(ids(spark, "a", "b", "c"), "k", "id", "t", database, key_type="bigint")
    assert dict(found.dtypes)["k"] == "bigint" and found.count() == 3


def test_batch_with_stable_keys(spark, database):
    folder = catalog.source_files(spark, SF_DIR)
    for _ in range(2):
        batch.run_batch(spark, catalog.source_paths(folder), database, stable_keys=True)
    kept = spark.table(f"{database}.silver_customer").select("Customer_PK", "Customer_ID")
    expected = catalog.customer_surrogate_key(spark, SF_DIR).join(kept.select("Customer_ID"), "Customer_ID").select(*kept.columns)
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, expected.collect()))
    assert dict(kept.dtypes)["Customer_PK"] == "int"
    rollback(spark, "silver_customer", database)


# --- rejected lines ---------------------------------------------------------------------------

CHECKED = "Customer_ID string, Customer_Name_Bad string, Phone_Bad boolean"


def matched(spark, orders, people, goods):
    return rejects.with_matches(
        spark.createDataFrame(orders, "Row_ID bigint, Customer_ID string, Product_ID string"),
        spark.createDataFrame(people, CHECKED),
        spark.createDataFrame([(g,) for g in goods], "Product_ID string"),
    )


def test_reasons_and_reconciliation(spark):
    people = [("A", "", False), ("A", "", False), ("A", "x", False), ("B", "1", False), ("C", None, False), (None, "", False)]
    goods = ["P", "Q", "Q", None]
    orders = [(1, "A", "P"), (2, "A", "Q"), (3, "B", "P"), (4, "C", "Q"), (5, "Z", "P"), (6, None, "P"), (7, "A", None), (8, "Z", "Y"), (8, "Z", "Y")]
    found = matched(spark, orders, people, goods)
    assert sorted((r.Row_ID, r.reason) for r in rejects.rejected_orders(found).collect()) == [
        (3, "invalid customer"), (4, "invalid customer"), (5, "unknown customer"), (6, "no customer id"),
        (7, "no product id"), (8, "unknown customer,unknown product"), (8, "unknown customer,unknown product"),
    ]
    assert {(r.Row_ID, r.copies) for r in found.filter("reason = ''").collect()} == {(1, 2), (2, 4)}
    enriched = spark.range(6)
    assert tuple(rejects.reconciliation(found, enriched).first()) == (9, 7, 4, 6, 0)
    assert rejects.reconciliation(found, spark.range(5)).first().missing == 1
    assert {(r.reason, r.n) for r in rejects.rejection_counts(found).collect()} >= {("invalid customer", 2)}


def test_nothing_to_reject(spark):
    none = matched(spark, [], [], [])
    assert rejects.rejected_orders(none).collect() == []
    assert tuple(rejects.reconciliation(none, spark.range(0)).first()) == (0, 0, 0, 0, 0)
    assert rejects.repeated_ids(spark.createDataFrame([("a",), ("a",), (None,)], "id string"), "id").collect() == [("a", 2)]


# --- hot keys -----------------------------------------------------------------------------------


@pytest.fixture
def plain_joins(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_frames(spark, copies=False):
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, 11).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 500)
    value = F.lit(1) if copies else F.col("id")
    fact = spark.range(0, 60_000, 1, 8).select(hot.cast("int").alias("k"), value.alias("v"))
    dim = spark.range(450).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("n"))
    return fact, dim.unionByName(dim.filter("k IN (7, 20)"))


def largest(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("copies", [False, True])
def test_no_task_gets_a_hot_key(spark, plain_joins, copies):
    fact, dim = hot_frames(spark, copies)
    plain, even = join_dimension(fact, dim, "k"), skew.skewed_join(fact, dim, "k")
    assert even.columns == plain.columns
    assert Counter(map(tuple, even.collect())) == Counter(map(tuple, plain.collect()))
    share = plain.count() / 32
    assert largest(plain) > 10 * share and largest(even) < 3 * share
    assert "BroadcastExchange" in even._jdf.queryExecution().executedPlan().toString()  # of the hot keys
    assert "CartesianProduct" not in even._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_found(spark):
    fact, _ = hot_frames(spark)
    found = dict(skew.hot_keys(fact, "k", tasks=16))
    assert set(found) == {7, 11} and found[7] > found[11] > 1
    assert skew.hot_keys(fact.filter("k > 100"), "k", tasks=16) == []
    assert skew.hot_keys(fact.limit(0), "k") == []
    text = fact.withColumn("k", F.col("k").cast("string"))
    assert {k for k, _ in skew.hot_keys(text, "k", tasks=16)} == {"7", "11"}


def test_small_dimension_or_no_hot_key(spark):
    fact, dim = hot_frames(spark)
    small = skew.skewed_join(fact, dim, "k", broadcast_limit=1 << 20)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, join_dimension(fact, dim, "k").collect()))
    even = fact.filter("k > 100")
    assert skew.skewed_join(even, dim, "k").count() == join_dimension(even, dim, "k").count()

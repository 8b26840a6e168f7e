"""Rules and operators against independent Python on many generated values."""

import datetime
import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tallyforge import __main__ as command
from tallyforge.functions.cleaning import clean_name, name_problem
from tallyforge.functions.money import money_sum
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.orders import ORDER_DATE_FORMAT
from tallyforge.plans.bronze_sample import bronze_customers, bronze_products, order_lines
from tallyforge.plans.catalog import _write_csv
from tallyforge.sinks.tables import cluster_by

SF_DIR = "/root/testdata/sf0.001"
TEXT = st.text(st.sampled_from(" \taZz09_-'.,{}2é漢😀"), max_size=12)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@FEW
@given(st.lists(TEXT, min_size=1, max_size=300))
def test_names_like_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    cleaned = df.select(clean_name(F.col("name")).alias("clean"))
    got = [tuple(r) for r in cleaned.select("clean", name_problem(F.col("clean"))).collect()]

    def expected(name):
        clean = re.sub(r"[^\w\s]", "", name, flags=re.ASCII).strip(" ")
        found = re.search(r"[^a-zA-Z\s{2,}]", clean, flags=re.ASCII)
        return clean, found.group() if found else ""

    assert got == [expected(n) for n in names]


@FEW
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=400), st.integers(1, 50))
def test_keys_like_python(spark, values, partitions):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, i int")
    got = add_dense_key(df, "pk", ["k"], partitions=partitions).orderBy("pk").collect()
    assert [r.pk for r in got] == list(range(1, len(values) + 1))
    ordered = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
    assert [r.k for r in got] == ordered
    assert Counter(r.i for r in got) == Counter(range(len(values)))


@FEW
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=300))
def test_sums_like_python(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] == sum(cents) / 100


def test_every_date_round_trips(spark):
    days = [datetime.date(1990, 1, 1) + datetime.timedelta(n) for n in range(0, 16_000, 3)]
    texts = [(f"{d.day}/{d.month}/{d.year}",) for d in days]
    texts += [(f"{d.day:02}/{d.month:02}/{d.year}",) for d in days]
    df = spark.createDataFrame(texts, "t string")
    assert [r[0] for r in df.select(F.try_to_date("t", ORDER_DATE_FORMAT)).collect()] == days * 2


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata", "Pacific/Apia"])
def test_results_do_not_depend_on_the_time_zone(spark, zone):
    names = ("profit_by_year", "enriched_orders", "sanitize_columns")
    queries = driver.queries()
    expected = [Counter(queries[n](spark, SF_DIR).collect()) for n in names]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [Counter(queries[n](spark, SF_DIR).collect()) for n in names] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_placement_of_hot_copies_repeats(spark):
    """A task that runs again must send every row, copies included, to the same partition."""
    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id").cast("int"))
    df = spark.range(0, 8_000, 1, 8).select(hot.alias("k"))
    placed = cluster_by(df, "k", partitions=8).groupBy(F.spark_partition_id().alias("p"), "k").count()
    first, second = (Counter(tuple(r) for r in placed.collect()) for _ in range(2))
    assert first == second
    assert len([1 for p, k, _ in first if k == 7]) >= 3


def test_results_do_not_depend_on_partitions_or_adaptive_execution(spark):
    names = ("profit_by_year", "gold_profit_agg", "enriched_customers", "gold_orders_clustered")
    queries = driver.queries()
    expected = [Counter(queries[n](spark, SF_DIR).collect()) for n in names]
    changed = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "20000",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        assert [Counter(queries[n](spark, SF_DIR).collect()) for n in names] == expected
    finally:
        for name in changed:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_command_line(spark, database, tmp_path, monkeypatch, capsys):
    order_lines(spark, SF_DIR).write.json(f"{tmp_path}/Orders.json")
    _write_csv(bronze_products(spark, SF_DIR), f"{tmp_path}/Products.csv")
    _write_csv(bronze_customers(spark, SF_DIR), f"{tmp_path}/Customer.csv")
    files = [f"{tmp_path}/{name}" for name in ("Customer.csv", "Orders.json", "Products.csv")]
    monkeypatch.setattr("sys.argv", ["tallyforge", *files, "--database", database, "--json-lines"])
    command.main()
    assert capsys.readouterr().out.count("loaded") == 3
    assert spark.table(f"{database}.gold_profit_agg").count() > 0


def test_money_sum_in_any_order(spark):
    values = [random.Random(1).randint(-(10**9), 10**9) / 100 for _ in range(5_000)]
    sums = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(seed + 2)
        sums.add(df.agg(money_sum(F.col("x"))).first()[0])
    assert len(sums) == 1

"""The customer rules on literal rows, default and strict."""

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.cleaning import address_line, clean_name, name_problem, phone_problem
from tallyforge.operators.customers import (
    bad_customers,
    clean_customers,
    enrich_customer_data,
    valid_customers,
    with_status,
)
from tallyforge.operators.quality import bad_customer_report, quarantine_counts
from tallyforge.schemas import CUSTOMERS, ENRICHED_CUSTOMER, SILVER_CUSTOMER, ddl

NAMES = [
    # name, cleaned, problem, strict problem
    ("  O'Brien-Smith ", "OBrienSmith", "", ""),
    ("José Ñu", "Jos u", "", ""),
    ("A1n", "A1n", "1", "1"),
    ("Pa_l", "Pa_l", "_", "_"),
    ("7t", "7t", "7", "7"),
    ("A2n", "A2n", "", "2"),
    ("{a,b}", "ab", "", ""),
    ("   ", "", "", "(empty)"),
    ("?!.", "", "", "(empty)"),
    ("\tTab", "\tTab", "", ""),
    (None, None, None, None),
]

PHONES = [
    # phone, problem, strict problem
    ("-123", False, True),
    ("\\-123", True, False),
    ("#ERROR!", True, True),
    ("#error", True, True),
    ("421.580.0902x9815", False, False),
    (None, None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_names(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame([(n[0],) for n in NAMES], "name string")
    cleaned = df.select("name", clean_name(F.col("name")).alias("clean"))
    got = cleaned.select(
        "name", "clean", name_problem(F.col("clean")), name_problem(F.col("clean"), strict=True)
    )
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [tuple(r) for r in got.collect()] == NAMES


def test_phones(spark):
    df = spark.createDataFrame([(p[0],) for p in PHONES], "phone string")
    got = df.select("phone", phone_problem(F.col("phone")), phone_problem(F.col("phone"), True))
    assert [tuple(r) for r in got.collect()] == PHONES


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_address_lines(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame(
        [("1 Main St, Apt 2, X",), ("Box 9",), ("",), (None,)], "address string"
    )
    got = df.select(address_line(F.col("address"), 0), address_line(F.col("address"), 1)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [tuple(r) for r in got] == [("1 Main St", "Apt 2"), ("Box 9", None), ("", None), (None, None)]


def customers(spark, rows):
    """Customers with the given (id, name, phone); the other columns are filled in."""
    full = [(i, name, "e", phone, "1 St, 2", "s", "c", "t", "st", "p", "r") for i, name, phone in rows]
    return spark.createDataFrame(full, ddl(CUSTOMERS))


EDGE_ROWS = [
    ("a", "Good", "555"),
    ("b", "A1n", "555"),
    ("c", "Good", "#ERROR!"),
    ("d", "A_n", "#ERROR!"),
    ("e", None, "555"),
    ("f", "Good", None),
    ("g", None, "#ERROR!"),
    ("h", "A1n", None),
    ("i", "A0n", "555"),
    ("j", "??", "555"),
    ("k", "Ann 2", "-5"),
]


def ids(df):
    return {r.Customer_ID for r in df.collect()}


def test_split_covers_every_customer(spark):
    checked = clean_customers(customers(spark, EDGE_ROWS))
    assert ids(valid_customers(checked)) == {"a", "j", "k"}
    assert ids(bad_customers(checked)) == {"b", "c", "d", "g", "h", "i"}
    assert ids(bad_customers(checked, loader_rule=True)) == {"b", "c", "d", "g", "h"}
    assert ids(with_status(checked).filter("status = 'unclassified'")) == {"e", "f"}
    counts = {r.status: r.n for r in quarantine_counts(checked).collect()}
    assert counts == {"valid": 3, "bad": 6, "unclassified": 2}


def test_strict_split(spark):
    checked = clean_customers(customers(spark, EDGE_ROWS), strict=True)
    assert ids(valid_customers(checked)) == {"a"}
    assert ids(bad_customers(checked)) == {"b", "c", "d", "g", "h", "i", "j", "k"}
    assert ids(with_status(checked).filter("status = 'unclassified'")) == {"e", "f"}


def test_report_reasons(spark):
    report = bad_customer_report(clean_customers(customers(spark, EDGE_ROWS)))
    assert {r.Customer_ID: r.reason for r in report.collect()} == {
        "b": "name", "c": "phone", "d": "name,phone", "g": "phone", "h": "name", "i": "name",
    }


def test_enriched_columns_and_keys(spark):
    enriched = enrich_customer_data(customers(spark, EDGE_ROWS))
    assert dict(enriched.dtypes) == ENRICHED_CUSTOMER
    assert enriched.columns == list(ENRICHED_CUSTOMER)
    keys = {r.Customer_ID: r.Customer_PK for r in enriched.collect()}
    assert keys == {row[0]: i + 1 for i, row in enumerate(EDGE_ROWS)}
    assert valid_customers(enriched).columns == list(SILVER_CUSTOMER)


@pytest.mark.parametrize("missing", ["Customer_ID", "Address", "Phone"])
def test_missing_column_is_named(spark, missing):
    kept = {name: kind for name, kind in CUSTOMERS.items() if name != missing}
    empty = spark.createDataFrame([], ddl(kept))
    with pytest.raises(ValueError, match=missing):
        enrich_customer_data(empty)


def test_all_missing_columns_are_named(spark):
    empty = spark.createDataFrame([], "Customer_ID string, Address_Line1 string")
    with pytest.raises(ValueError, match="'Customer_Name'.*'Phone'.*'Address'"):
        clean_customers(empty)

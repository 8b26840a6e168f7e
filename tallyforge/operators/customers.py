"""Customer enrichment and the split into valid, bad and unclassified customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.cleaning import address_line, clean_name, name_problem, phone_problem
from tallyforge.operators.columns import require_columns
from tallyforge.operators.keys import add_dense_key
from tallyforge.operators.registry import add_registered_key
from tallyforge.schemas import CUSTOMERS, ENRICHED_CUSTOMER, SILVER_CUSTOMER

NAME_IS_BAD = "Customer_Name_Bad"
PHONE_IS_BAD = "Phone_Bad"


def clean_customers(df: DataFrame, strict: bool = False) -> DataFrame:
    """Cleaned name, split address and the two flags: a narrow step that never shuffles.

    It adds no surrogate key, so the order join can use it without paying for one.
    """
    require_columns(df, CUSTOMERS, "customers")
    # The cleaned name is replaced first because its flag looks at the cleaned text.
    return df.withColumn("Customer_Name", clean_name(F.col("Customer_Name"))).withColumns(
        {
            "Address_Line1": address_line(F.col("Address"), 0),
            "Address_Line2": address_line(F.col("Address"), 1),
            NAME_IS_BAD: name_problem(F.col("Customer_Name"), strict),
            PHONE_IS_BAD: phone_problem(F.col("Phone"), strict),
        }
    )


def enrich_customer_data(
    df: DataFrame, strict: bool = False, key_type: str = "int", registry: tuple[str, str] | None = None
) -> DataFrame:
    """The enriched customer: ``Customer_PK`` 1..n by ``Customer_ID``, cleaned fields, flags.

    The key counts all customers, also those later found bad, and holds for one run only, unless
    ``registry`` names a table and its database that remember the keys. Over 2,147,483,647
    customers need ``key_type="bigint"``.
    """
    require_columns(df, CUSTOMERS, "customers")
    if registry:
        keyed = add_registered_key(df, "Customer_PK", "Customer_ID", *registry, key_type=key_type)
    else:
        keyed = add_dense_key(df, "Customer_PK", ["Customer_ID"], key_type)
    return clean_customers(keyed, strict).select(*ENRICHED_CUSTOMER)


def is_valid() -> Column:
    """Both flags are known and clear."""
    return (F.col(NAME_IS_BAD) == "") & ~F.col(PHONE_IS_BAD)


def is_bad() -> Column:
    """At least one flag is set."""
    return (F.col(NAME_IS_BAD) != "") | F.col(PHONE_IS_BAD)


def is_bad_by_loader_rule() -> Column:
    """The narrower rule that reads the name flag as a boolean, so only text like ``1`` counts."""
    return F.col(NAME_IS_BAD).try_cast("boolean") | F.col(PHONE_IS_BAD)


def valid_customers(enriched: DataFrame) -> DataFrame:
    kept = [name for name in SILVER_CUSTOMER if name in enriched.columns]
    return enriched.filter(is_valid()).select(*kept)


def bad_customers(enriched: DataFrame, loader_rule: bool = False) -> DataFrame:
    return enriched.filter(is_bad_by_loader_rule() if loader_rule else is_bad())


def with_status(enriched: DataFrame) -> DataFrame:
    """Add ``status``: ``valid``, ``bad``, or ``unclassified`` where a NULL leaves it open."""
    status = F.when(is_valid(), "valid").when(is_bad(), "bad").otherwise("unclassified")
    return enriched.withColumn("status", status)

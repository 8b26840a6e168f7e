"""Data-quality reports, each one aggregate or one filter over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.columns import require_columns
from tallyforge.operators.customers import NAME_IS_BAD, PHONE_IS_BAD, bad_customers, with_status


def bad_customer_report(enriched: DataFrame) -> DataFrame:
    """Bad customers with the reason: ``name``, ``phone`` or ``name,phone``."""
    reason = F.concat_ws(
        ",",
        F.when(F.col(NAME_IS_BAD) != "", "name"),
        F.when(F.col(PHONE_IS_BAD), "phone"),
    )
    return bad_customers(enriched).select(
        "Customer_ID", "Customer_Name", "Phone", reason.alias("reason")
    )


def quarantine_counts(enriched: DataFrame) -> DataFrame:
    """Customers per status; the three counts cover every row."""
    return with_status(enriched).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def cast_audit(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """How many values of each column do not convert to its declared type.

    One pass computes all counters; the single result row is then turned into one per column.
    """
    require_columns(df, declared, "audited frame")
    counters = df.agg(
        *[
            F.count_if(F.col(f"`{name}`").isNotNull() & F.col(f"`{name}`").try_cast(kind).isNull())
            .alias(f"failed_{i}")
            for i, (name, kind) in enumerate(declared.items())
        ]
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("target_type"),
            F.col(f"failed_{i}").alias("n_failed"),
        )
        for i, (name, kind) in enumerate(declared.items())
    ]
    return counters.select(F.inline(F.array(*entries)))

"""Profit totals.

``profit_agg`` builds the gold aggregate. The reports take that aggregate or, equally well, the
lines of ``with_year``: cents add up exactly, so skipping the aggregate gives the same totals
and spares its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.money import money_sum
from tallyforge.schemas import GOLD_PROFIT_AGG

AGG_KEYS = [name for name in GOLD_PROFIT_AGG if name != "Profit"]


def with_year(enriched: DataFrame) -> DataFrame:
    """Order lines reduced to the columns of the gold aggregate; an unknown date has no year."""
    return enriched.withColumn("Year", F.year("Order_Date")).select(*GOLD_PROFIT_AGG)


def profit_agg(enriched: DataFrame) -> DataFrame:
    """Profit by year, category, sub-category and customer name (namesakes are merged)."""
    return with_year(enriched).groupBy(*AGG_KEYS).agg(money_sum(F.col("Profit")).alias("Profit"))


def _totals(agg: DataFrame, *keys: str) -> DataFrame:
    return agg.groupBy(*keys).agg(F.round(money_sum(F.col("Profit")), 2).alias("Profit"))


def profit_by_year(agg: DataFrame) -> DataFrame:
    return _totals(agg, "Year").orderBy("Year")


def profit_by_customer(agg: DataFrame, customer: str | None = None) -> DataFrame:
    if customer is not None:
        agg = agg.filter(F.col("Customer_Name") == customer)
    return _totals(agg, "Customer_Name")


def profit_by_year_customer(agg: DataFrame, customer: str | None = None) -> DataFrame:
    if customer is not None:
        agg = agg.filter(F.col("Customer_Name") == customer)
    # The second sort key also lets the range sort split a year too big for one task.
    return _totals(agg, "Year", "Customer_Name").orderBy("Year", "Customer_Name")


def profit_by_year_category(agg: DataFrame, category: str | None = None) -> DataFrame:
    if category is not None:
        agg = agg.filter(F.col("Category") == category)
    return _totals(agg, "Year", "Category").orderBy("Year", "Category")


# The reports and the columns each groups by.
REPORTS = {
    "profit_by_year": ("Year",),
    "profit_by_customer": ("Customer_Name",),
    "profit_by_year_customer": ("Year", "Customer_Name"),
    "profit_by_year_category": ("Year", "Category"),
}
REPORT_KEYS = ["Year", "Customer_Name", "Category"]


def profit_reports(agg: DataFrame) -> DataFrame:
    """All reports by one pass and one shuffle: ``report``, its keys, and ``Profit``.

    Keys that a report does not group by are NULL. ``report`` comes from the grouping set and not
    from these, so an unknown year is a row of its own beside the totals over all years.
    """
    sets = [[F.col(c) for c in keys] for keys in REPORTS.values()]
    grouped = agg.groupingSets(sets, *REPORT_KEYS).agg(
        F.grouping_id(*REPORT_KEYS).alias("_set"), F.round(money_sum(F.col("Profit")), 2).alias("Profit")
    )
    report = F.lit(None).cast("string")
    for name, keys in REPORTS.items():
        # A bit is set for each column that is not grouped by, the first column's highest.
        absent = sum(1 << i for i, c in enumerate(reversed(REPORT_KEYS)) if c not in keys)
        report = F.when(F.col("_set") == absent, name).otherwise(report)
    return grouped.select(report.alias("report"), *REPORT_KEYS, "Profit")


def report_slice(reports: DataFrame, name: str) -> DataFrame:
    """One report out of all of them, with its own columns."""
    return reports.filter(F.col("report") == name).select(*REPORTS[name], "Profit")


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))

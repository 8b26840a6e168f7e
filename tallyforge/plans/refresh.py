"""Bring gold tables up to date from the lines that changed, without a full rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.profit import profit_agg
from tallyforge.sinks.publish import current_version, qualified
from tallyforge.sinks.tables import overwrite_clustered
from tallyforge.workspace import shared_folder


def change_orders(
    spark: SparkSession, changed: DataFrame, database: str = "default", removed: DataFrame | None = None
) -> list[int | None]:
    """Put changed lines in place of those with their ``Row_ID``, or add them, drop those whose
    ``Row_ID`` is in ``removed``, and return the years that lines came into or went out of.

    ``changed`` has the columns of ``gold_orders``. The lines of the order table that stay are
    copied, so that it remains clustered; the aggregate need not be.
    """
    now = spark.table(qualified("gold_orders", database))
    folder = shared_folder(spark)
    changed.select(*now.columns).write.parquet(folder, compression="zstd")
    changed = spark.read.schema(now.schema).parquet(folder)
    gone = changed.select("Row_ID")
    if removed is not None:
        gone = gone.unionByName(removed.select("Row_ID"))
    gone = gone.distinct()
    replaced = now.join(gone, "Row_ID", "left_semi")
    years = touched_years(replaced.select("Order_Date").unionByName(changed.select("Order_Date")))
    # A NULL Row_ID equals none, so its lines are only ever added.
    overwrite_clustered(now.join(gone, "Row_ID", "left_anti").unionByName(changed), "gold_orders", "Row_ID", database)
    return years


def touched_years(dates: DataFrame) -> list[int | None]:
    """The years of all dates, a line without a date counting to no year."""
    found = dates.select(F.year("Order_Date").alias("Year")).distinct().collect()
    return sorted((row.Year for row in found), key=lambda year: (year is not None, year))


def of_years(year: Column, years: list[int | None]) -> Column:
    known = [y for y in years if y is not None]
    return year.isin(known) | year.isNull() if None in years else year.isin(known)


def refresh_profit_agg(spark: SparkSession, years: list[int | None], database: str = "default") -> None:
    """Build the profit aggregate anew for these years from ``gold_orders``; the folders of all
    other years stay as they are.

    The years are written aside and moved into place when all are complete, a year that has lost
    its last line is dropped. Of the order table, files without a date of these years are skipped.
    """
    if not years:
        return
    table = qualified(current_version(spark, "gold_profit_agg", database), database)
    lines = spark.table(qualified("gold_orders", database)).filter(of_years(F.year("Order_Date"), years))
    fresh = profit_agg(lines).hint("rebalance", "Year")
    order = spark.table(table).columns
    folder = shared_folder(spark)
    fresh.select(*order).write.parquet(folder)  # so that nothing is moved unless all is computed
    # Which partitions an insert overwrites is a setting of the session, and this one's stay.
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    fresh = other.read.schema(fresh.select(*order).schema).parquet(folder)
    left = {row.Year for row in fresh.select("Year").distinct().collect()}
    if left:
        fresh.write.mode("overwrite").insertInto(table)
    for year in years:
        if year not in left:
            literal = "null" if year is None else str(year)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (Year = {literal})")
    spark.catalog.refreshTable(table)

"""Load source files into bronze tables, each file by the kind its path names."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.columns import sanitize_cols
from tallyforge.sinks.tables import overwrite_table, qualified
from tallyforge.sources.files import (
    CORRUPT,
    file_format,
    read_customers,
    read_orders_json,
    read_products_csv,
)
from tallyforge.workspace import shared_folder

log = logging.getLogger(__name__)

MANIFEST = (
    "file string, table_name string, status string, row_count bigint, corrupt_rows bigint, error string"
)

# The text in a path that decides its kind, in order of precedence, and the table.
ROUTES = {
    "Orders": "bronze_orders",
    "Products": "bronze_products",
    "Customer": "bronze_customer",
}


def target_table(path: str) -> str:
    """The bronze table a path belongs to; case matters and the first match wins."""
    for text, table in ROUTES.items():
        if text in path:
            return table
    raise ValueError(f"unknown kind of file: {path}")


def read_source(
    spark: SparkSession, path: str, multiline: bool | None = None, options: dict | None = None
) -> DataFrame:
    """The rows at ``path`` with sanitized names, and the text of those that do not fit.

    ``options`` holds keyword arguments of the readers by table.
    """
    table = target_table(path)
    chosen = (options or {}).get(table, {})
    if table == "bronze_orders":
        file_format(spark, path, "json")
        rows = read_orders_json(spark, path, multiline, corrupt=True, **chosen)
    elif table == "bronze_products":
        file_format(spark, path, "csv")
        rows = read_products_csv(spark, path, corrupt=True, **chosen)
    else:
        rows = read_customers(spark, path, corrupt=True, **chosen)
    return sanitize_cols(rows)


def load_table(spark: SparkSession, table: str, rows: list[DataFrame], database: str) -> list[tuple[int, int]]:
    """Write the rows of all sources of a table at once. Returns the rows and the corrupt rows
    of each source, counted while they are written, so every source is scanned once.

    The written table is also registered as the temporary view ``<table>_loaded``; a view with
    the table's own name would hide the table.
    """
    numbered = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(rows)]
    counts = []
    for i in range(len(rows)):
        own = F.col("_source") == i
        counts.append(F.count_if(own).alias(f"rows_{i}"))
        counts.append(F.count_if(own & F.col(CORRUPT).isNotNull()).alias(f"corrupt_{i}"))
    counted = Observation()
    # Nothing shuffles between the counter and the write, so a retried task counts once.
    together = reduce(DataFrame.unionByName, numbered).observe(counted, *counts)
    overwrite_table(together.drop("_source", CORRUPT), table, database)
    spark.table(qualified(table, database)).createOrReplaceTempView(f"{table}_loaded")
    return [(counted.get[f"rows_{i}"], counted.get[f"corrupt_{i}"]) for i in range(len(rows))]


def ingest_entries(
    spark: SparkSession,
    paths: Iterable[str],
    database: str = "default",
    multiline: bool | None = None,
    options: dict | None = None,
) -> list[dict]:
    """Load every path and return the manifest rows, one per path.

    A path is a file, a folder or a pattern. All paths of one kind are written together. A path
    that cannot be read gets an ``error`` row, and the others of its kind are loaded without it:
    where writing them together fails, each is written by itself first. If none can be read, the
    table stays as it is. ``ledger.ingest_new_files`` does the same file by file.
    Rows that do not fit the schema are loaded as far as they do, and counted.
    """
    entries, sources = [], {}
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        entry = dict.fromkeys(part.split()[0] for part in MANIFEST.split(", ")) | {"file": name, "status": "error"}
        entries.append(entry)
        try:
            entry["table_name"] = target_table(path)
            rows = read_source(spark, path, multiline, options)
            sources.setdefault(entry["table_name"], []).append((entry, rows))
        except Exception as failure:  # one bad path must not stop the others
            log.error("could not read %s: %s", path, failure)
            entry["error"] = str(failure)
    for table, members in sources.items():
        try:
            load_members(spark, table, members, database)
        except Exception as failure:
            log.error("could not load %s together: %s", table, failure)
            try:
                if sound := staged_members(spark, members):
                    load_members(spark, table, sound, database)
            except Exception as failure:
                log.error("could not load %s: %s", table, failure)
                for entry, _ in members:
                    entry["error"] = entry["error"] or str(failure)
    return entries


def load_members(spark: SparkSession, table: str, members: list[tuple[dict, DataFrame]], database: str) -> None:
    """Load the rows of a table's sources together and fill in their manifest rows."""
    counts = load_table(spark, table, [rows for _, rows in members], database)
    for (entry, _), (rows, corrupt) in zip(members, counts):
        entry |= {"status": "loaded", "row_count": rows, "corrupt_rows": corrupt}


def staged_members(spark: SparkSession, members: list[tuple[dict, DataFrame]]) -> list[tuple[dict, DataFrame]]:
    """Those sources that can be written by themselves, as written; the others get an error."""
    sound = []
    for entry, rows in members:
        folder = shared_folder(spark)
        try:
            rows.write.parquet(folder)
            sound.append((entry, spark.read.schema(rows.schema).parquet(folder)))
        except Exception as failure:
            log.error("could not load %s: %s", entry["file"], failure)
            entry["error"] = str(failure)
    return sound


def ingest(
    spark: SparkSession,
    paths: Iterable[str],
    database: str = "default",
    multiline: bool | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Load every path and return the manifest; see ``ingest_entries``."""
    return spark.createDataFrame(ingest_entries(spark, paths, database, multiline, options), MANIFEST)


def load_file(
    path: str,
    spark: SparkSession,
    database: str = "default",
    multiline: bool | None = None,
    options: dict | None = None,
) -> dict:
    """Read, sanitize and write what is at one path. Returns its manifest row, also on failure."""
    return ingest_entries(spark, [path], database, multiline, options)[0]


def row_counts(manifest: DataFrame) -> DataFrame:
    """Rows of every table that was loaded, over all its sources."""
    loaded = manifest.filter(F.col("status") == "loaded")
    return loaded.groupBy("table_name").agg(F.sum("row_count").alias("n"))

"""Overwriting Parquet tables, plain, partitioned or clustered.

Each overwrite is a new version of the table that replaces the old one at once, and only if it
was written whole; see ``publish``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sinks.bloom import bloom_options
from tallyforge.sinks.publish import drop_published, publish, qualified
from tallyforge.workspace import shared_folder

ROWS_PER_FILE = 1_000_000
MIN_ROWS_PER_FILE = 50_000


def drop_table(spark: SparkSession, table: str, database: str = "default") -> None:
    """Drop a table with all its versions. A rebuild needs no drop; overwrite with
    ``merge_schema=False`` instead, which readers see no gap of."""
    drop_published(spark, table, database)


def with_table_schema(df: DataFrame, table: str, database: str = "default") -> DataFrame:
    """``df`` with the columns of the existing table first, those it lacks as typed NULLs.

    New columns follow. A shared column whose type differs raises, with all such columns named.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(qualified(table, database)):
        return df
    existing = spark.table(qualified(table, database)).dtypes
    incoming = {name.lower(): (name, kind) for name, kind in df.dtypes}
    clashes = [
        f"{name}: {kind} in the table, {incoming[name.lower()][1]} in the data"
        for name, kind in existing
        if name.lower() in incoming and incoming[name.lower()][1] != kind
    ]
    if clashes:
        raise ValueError(f"types do not match those of {table}: {'; '.join(clashes)}")
    kept = [
        F.col(f"`{incoming[name.lower()][0]}`").alias(name)
        if name.lower() in incoming
        else F.lit(None).cast(kind).alias(name)
        for name, kind in existing
    ]
    known = {name.lower() for name, _ in existing}
    added = [F.col(f"`{name}`") for name in df.columns if name.lower() not in known]
    return df.select(*kept, *added)


def overwrite_table(
    df: DataFrame, table: str, database: str = "default", merge_schema: bool = True
) -> None:
    """Replace the rows of a table. Its columns stay, and new columns are added to them; without
    ``merge_schema`` it gets those of ``df``."""
    publish(with_table_schema(df, table, database) if merge_schema else df, table, database)


def overwrite_partitioned(
    df: DataFrame, table: str, partition_by: str, database: str = "default", merge_schema: bool = True
) -> None:
    """Replace a table that has one folder per value of ``partition_by``.

    ``REBALANCE`` brings the rows of a value together, so that there are few files, while AQE
    splits a value that is too big for one task and merges small ones.
    """
    whole = with_table_schema(df, table, database) if merge_schema else df
    publish(whole.hint("rebalance", partition_by), table, database, partition_by)


def cluster_by(df: DataFrame, column: str, partitions: int) -> DataFrame:
    """Partition by ranges of ``column`` and sort, so that each file covers a narrow range.

    Spark samples ``df`` for the ranges and then reads it again, so it should be a written table.
    Rows of a frequent value are told apart by a hash, and copies of one row by their place in
    the input, so such a value is spread over several files. The hash is no column of its own, as
    the shuffle would carry it along and cannot compress it.
    """
    numbered = df.withColumn("_copy", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(partitions, column, F.xxhash64(*df.columns), "_copy")
    return ranged.sortWithinPartitions(column).drop("_copy")


def file_count(spark: SparkSession, rows: int) -> int:
    """Files of up to ``ROWS_PER_FILE`` rows, fewer per file while that keeps tasks busy."""
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    busy = min(parallel, rows // MIN_ROWS_PER_FILE)
    return max(1, busy, math.ceil(rows / ROWS_PER_FILE))


def overwrite_clustered(
    df: DataFrame,
    table: str,
    column: str,
    database: str = "default",
    partitions: int | None = None,
    merge_schema: bool = True,
    bloom: Sequence[str] = (),
) -> None:
    """Replace a table whose files cover narrow ranges of ``column``; see ``cluster_by``.

    The rows are first written as they come, so what is below ``df`` runs once, and the written
    rows are then clustered. The columns in ``bloom`` get Bloom filters, so that a lookup by one of
    them reads only the row groups that may have the value.
    """
    spark = df.sparkSession
    whole = with_table_schema(df, table, database) if merge_schema else df
    folder = shared_folder(spark)
    whole.write.parquet(folder, compression="zstd")  # scratch: as short as it gets
    written = spark.read.schema(whole.schema).parquet(folder)
    files = partitions or file_count(spark, written.count())
    options = bloom_options(written, list(bloom), files) if bloom else None
    publish(cluster_by(written, column, files), table, database, options=options)


def overwrite_by_status(
    df: DataFrame, table: str, database: str = "default", merge_schema: bool = True
) -> None:
    """Write checked customers to one table with a folder per status, in a single pass."""
    overwrite_partitioned(df, table, "status", database, merge_schema)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory, spilling to disk, while several writes read it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()

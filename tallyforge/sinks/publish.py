"""Tables whose content changes all at once.

A table's name is a view on its current version, and every version is a managed table of its own.
A new version is written and verified first, and one change of the catalog, the view's, then
brings it to the readers. A build that fails leaves the name as it was. The version before is
kept, so that frames which already read it still can, and so that the switch can be taken back.

``ALTER TABLE ... SET LOCATION`` would do the same for a table without partitions only: the
locations of partitions stay in the catalog as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyforge.workspace import delete_folder

#: Versions that stay, the current one included.
KEPT = 2
VERSION = re.compile(r"(?P<table>.+)__v(?P<number>\d{6,})_[0-9a-f]{8}")


class PublishError(RuntimeError):
    """A new version does not hold what was written to it."""


def qualified(table: str, database: str = "default") -> str:
    return f"`{database}`.`{table}`"


def versions(spark: SparkSession, table: str, database: str = "default") -> list[str]:
    """The table's versions that are in the catalog, oldest first."""
    found = []
    for row in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table.lower()}__v*'").collect():
        match = VERSION.fullmatch(row.tableName)
        if match and match["table"] == table.lower():
            found.append((int(match["number"]), row.tableName))
    return [name for _, name in sorted(found)]


def property_of(spark: SparkSession, table: str, key: str, database: str = "default") -> str | None:
    """A property of the view of that name, or ``None`` where there is no such view or property."""
    if not is_view(spark, table, database):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {qualified(table, database)}").collect()
    return next((row.value for row in rows if row.key == key), None)


def is_view(spark: SparkSession, table: str, database: str = "default") -> bool:
    return spark.catalog.tableExists(qualified(table, database)) and (
        spark.catalog.getTable(qualified(table, database)).tableType == "VIEW"
    )


def current_version(spark: SparkSession, table: str, database: str = "default") -> str | None:
    return property_of(spark, table, "version", database)


def switch_to(spark: SparkSession, table: str, query: str, database: str = "default", **properties: str) -> None:
    """Make the name a view on ``query``. A plain table of that name, which an earlier release
    may have left, is dropped first, the only case in which readers see a gap."""
    name = qualified(table, database)
    if spark.catalog.tableExists(name) and not is_view(spark, table, database):
        spark.sql(f"DROP TABLE {name}")
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS {query}")


def select_version(version: str, database: str) -> str:
    return f"SELECT * FROM {qualified(version, database)}"


def database_folder(spark: SparkSession, database: str = "default") -> str:
    rows = spark.sql(f"DESCRIBE DATABASE `{database}`").collect()
    return next(row.info_value for row in rows if row.info_name == "Location").rstrip("/")


def publish(
    df: DataFrame,
    table: str,
    database: str = "default",
    partition_by: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
    keep: int = KEPT,
    options: dict[str, str] | None = None,
) -> str:
    """Write ``df`` as a new version of the table, verify it, and switch the name to it.

    Verified is that the version holds as many rows as the tasks wrote, and what ``check`` asks
    of it; ``check`` raises to refuse it. Whatever fails, the version is removed and the name
    keeps its content. ``df`` may read the table itself. ``options`` go to the Parquet writer.
    Returns the version's name. Only the ``keep`` newest versions and the current one stay.
    """
    spark = df.sparkSession
    known = versions(spark, table, database)
    number = max((int(VERSION.fullmatch(v)["number"]) for v in known), default=0) + 1
    version = f"{table.lower()}__v{number:06d}_{uuid4().hex[:8]}"
    try:
        # On top of any shuffle, so the write's own tasks count, and a retried one counts once.
        written = Observation()
        writer = df.observe(written, F.count(F.lit(1)).alias("n")).write.format("parquet").options(**options or {})
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(qualified(version, database))
        made = spark.table(qualified(version, database))
        if (n := made.count()) != written.get["n"]:
            raise PublishError(f"{version} holds {n} rows, but {written.get['n']} were written")
        if check:
            check(made)
        switch_to(spark, table, select_version(version, database), database, version=version)
    except BaseException:
        discard(spark, version, database)
        raise
    expire(spark, table, database, keep)
    return version


def discard(spark: SparkSession, version: str, database: str = "default") -> None:
    """Remove a version and the files a write that did not finish may have left."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(version, database)}")
    delete_folder(spark, f"{database_folder(spark, database)}/{version}")


def expire(spark: SparkSession, table: str, database: str = "default", keep: int = KEPT) -> None:
    """Drop all versions but the ``keep`` newest and the current one."""
    current = current_version(spark, table, database)
    known = versions(spark, table, database)
    for version in known[: max(0, len(known) - keep)]:
        if version != current:
            spark.sql(f"DROP TABLE IF EXISTS {qualified(version, database)}")


def rollback(spark: SparkSession, table: str, database: str = "default", to: str | None = None) -> str:
    """Switch the name back to the version before the current one, or to the one named."""
    current, known = current_version(spark, table, database), versions(spark, table, database)
    if to is None:
        earlier = known[: known.index(current)] if current in known else []
        if not earlier:
            raise ValueError(f"{table} has no version before {current}")
        to = earlier[-1]
    elif to not in known:
        raise ValueError(f"{table} has no version {to}; there are {known}")
    switch_to(spark, table, select_version(to, database), database, version=to)
    return to


def drop_published(spark: SparkSession, table: str, database: str = "default") -> None:
    """Drop the name and all its versions; a plain table too."""
    kind = "VIEW" if is_view(spark, table, database) else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS {qualified(table, database)}")
    for version in versions(spark, table, database):
        spark.sql(f"DROP TABLE IF EXISTS {qualified(version, database)}")

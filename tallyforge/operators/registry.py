"""Surrogate keys that stay: a registry remembers the key of every id it has seen.

Ids the registry does not have get the next keys in order of id; ids that vanish keep theirs and
find them again. The registry grows by one written part per run, which one change of the
catalog brings into view, so a run that fails gives out no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.keys import INT_MAX, add_dense_key
from tallyforge.sinks.publish import database_folder, property_of, qualified, switch_to
from tallyforge.workspace import delete_folder


def _same(left: DataFrame, right: DataFrame, name: str):
    return left[name].eqNullSafe(right[name])


def registry(spark: SparkSession, table: str, database: str = "default") -> DataFrame | None:
    """The key and the id of everything registered, or ``None`` before the first run."""
    if property_of(spark, table, "load", database) is None:
        return None
    return spark.table(qualified(table, database))


def register(
    df: DataFrame, key: str, id_column: str, table: str, database: str = "default", key_type: str = "int"
) -> DataFrame:
    """Give every id of ``df`` that has none the next key, and return the registry: ``key`` and
    ``id_column``.

    Keys run from 1 on without gaps, in order of id within a run, NULL being an id and the first.
    Only new ids are sorted and written. One run at a time may register for a table.
    """
    spark = df.sparkSession
    load = int(property_of(spark, table, "load", database) or 0) + 1
    last = int(property_of(spark, table, "last", database) or 0)
    known = registry(spark, table, database)
    ids = df.select(id_column).distinct()
    if known is not None:
        ids = ids.join(known, _same(ids, known, id_column), "left_anti")
    base = f"{database_folder(spark, database)}/{table}__keys"
    folder = f"{base}/_load={load}"
    delete_folder(spark, folder)  # of a run that was interrupted
    numbered = add_dense_key(ids, key, [id_column], "bigint")
    numbered.select((F.col(key) + last).cast(key_type).alias(key), id_column).write.parquet(folder)
    made = spark.read.parquet(folder)
    count, least, most = made.agg(F.count("*"), F.min(key), F.max(key)).first()
    if key_type == "int" and last + count > INT_MAX:
        raise ValueError(f"{last + count} ids need a bigint {key}; pass key_type='bigint'")
    if count and (least, most) != (last + 1, last + count):
        raise RuntimeError(f"keys {least} to {most} were given to {count} ids after {last}")
    if count or known is None:
        query = f"SELECT `{key}`, `{id_column}` FROM parquet.`{base}` WHERE _load <= {load}"
        switch_to(spark, table, query, database, load=str(load), last=str(last + count))
    return spark.table(qualified(table, database))


def add_registered_key(
    df: DataFrame, key: str, id_column: str, table: str, database: str = "default", key_type: str = "int"
) -> DataFrame:
    """Add ``key`` in front, from the registry. Rows that repeat an id share its key."""
    keys = register(df, key, id_column, table, database, key_type)
    return df.join(keys, _same(df, keys, id_column)).select(keys[key], *[df[c] for c in df.columns])

"""Joins in which a few keys hold most of the rows, without adaptive execution.

A mergeable sketch, one small aggregate, finds the keys with more rows than a task should get.
Their rows are dealt over as many pieces as it takes, the dimension's rows for them are repeated
once for each piece, and one join on key and piece does the rest. All other keys are one piece.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.joins import join_dimension, row_bytes

#: Keys the sketch follows. One that holds over 1 / TRACKED of the rows is found for certain, and
#: at most HOT are cut, so what is sent to every task has that many rows.
TRACKED = 8192
HOT = 1024
#: Pieces for each share of a task, as hashing deals few large pieces unevenly.
FINER = 4


def hot_keys(df: DataFrame, key: str, tasks: int | None = None) -> list[tuple[object, int]]:
    """The keys with more rows than the share of one of ``tasks``, and how many pieces to cut each
    into. ``tasks`` defaults to the session's number of shuffle partitions; more than ``HOT`` are
    of no use, as no key beyond those counted can be larger than such a share."""
    tasks = min(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), HOT)
    known = df.filter(F.col(key).isNotNull())
    found, total = known.agg(F.expr(f"approx_top_k(`{key}`, {HOT}, {TRACKED})"), F.count("*")).first()
    share = max(1, total // tasks)
    return [(row.item, math.ceil(FINER * row["count"] / share)) for row in found or [] if row["count"] > share]


def skewed_join(
    fact: DataFrame, dimension: DataFrame, key: str, tasks: int | None = None, broadcast_limit: int | None = None
) -> DataFrame:
    """Inner equi-join on ``key`` with the rows and columns of ``join_dimension``, in which no task
    gets much more than its share of the fact rows, whatever key they have.

    A dimension that measures up to ``broadcast_limit`` is broadcast instead, which makes hot keys
    harmless. The fact rows are read once more, for the sketch, and of them the key only.
    """
    if broadcast_limit and row_bytes(dimension) <= broadcast_limit:
        return join_dimension(fact, dimension, key, broadcast_limit)
    hot = hot_keys(fact, key, tasks)
    if not hot:
        return join_dimension(fact, dimension, key)
    spark = fact.sparkSession
    kind = dict(fact.dtypes)[key]
    pieces = F.broadcast(spark.createDataFrame(hot, f"`{key}` {kind}, _pieces int"))  # at most HOT rows
    cut = F.coalesce("_pieces", F.lit(1))
    # Dealt by place, so that rows which are alike in all columns are spread too.
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), cut).cast("int")
    dealt = fact.join(pieces, key, "left").withColumn("_piece", piece).drop("_pieces")
    repeated = dimension.join(pieces, key, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), cut - 1)))
    joined = dealt.join(repeated.drop("_pieces"), [key, "_piece"])
    others = [c for c in [*fact.columns, *dimension.columns] if c != key]
    return joined.select(key, *[F.col(f"`{c}`") for c in others])

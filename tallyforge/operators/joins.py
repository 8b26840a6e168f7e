"""Joining a large fact frame to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of dimension rows up to which a broadcast to every executor is accepted.
BROADCAST_LIMIT = 256 * 1024 * 1024


def row_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a frame, measured by one aggregate over it."""
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    # Eight bytes per field plus row header, and each text padded to a multiple of eight.
    fixed = 24 + 8 * len(df.columns) + 8 * len(texts)
    size = sum((F.coalesce(t, F.lit(0)).cast("bigint") for t in texts), F.lit(fixed).cast("bigint"))
    return df.agg(F.sum(size)).first()[0] or 0


def join_dimension(
    fact: DataFrame, dimension: DataFrame, key: str, broadcast_limit: int | None = None, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key``; NULL keys match nothing, repeated dimension keys fan out.

    Without ``broadcast_limit`` the choice is left to Catalyst and AQE: broadcast below the
    session's threshold, else sort-merge, where AQE splits the partition of a hot key.

    With it the dimension is measured first. Up to the limit it is broadcast, which spares the
    shuffle of the whole fact frame and makes hot keys harmless; above it the plan is as before.
    A session that turned broadcasts off gets none.
    """
    if int(fact.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) < 0:
        broadcast_limit = None
    if broadcast_limit and row_bytes(dimension) <= broadcast_limit:
        dimension = F.broadcast(dimension)
    return fact.join(dimension, key, how)

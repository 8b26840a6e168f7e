"""Tables laid out along a Z curve, so that filters on any of several columns skip files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sinks.publish import publish
from tallyforge.sinks.tables import file_count, with_table_schema
from tallyforge.workspace import shared_folder

#: Bits of a column's rank; fewer with more than seven columns, as all must fit a bigint.
BITS = 8
ACCURACY = 10_000
#: Leading bytes of a text that its place among others is told by.
TEXT_BYTES = 7


def sortable(column: str, kind: str) -> Column:
    """A number that orders like the column: texts by their first bytes, dates by their day."""
    value = F.col(f"`{column}`")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind.startswith("timestamp"):
        return value.cast("timestamp").cast("double")
    if kind == "string":
        head = F.rpad(F.substring(F.encode(value, "UTF-8"), 1, TEXT_BYTES), TEXT_BYTES, F.lit(b"\x00"))
        return F.conv(F.hex(head), 16, 10).cast("double")
    return value.cast("double")


def rank(value: Column, bounds: list[float]) -> Column:
    """How many of the ascending ``bounds`` a value is not below, by halving. NULL is rank 0."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < bounds[middle], among(low, middle)).otherwise(among(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(among(0, len(bounds)))


def z_value(df: DataFrame, columns: list[str]) -> Column:
    """The bits of the columns' ranks in turn, the highest first.

    The ranks are by quantiles, which one aggregate over the columns finds approximately; the
    driver gets at most 255 bounds for each.
    """
    bits = min(BITS, 63 // len(columns))
    kinds = dict(df.dtypes)
    values = [sortable(c, kinds[c]) for c in columns]
    parts = 1 << bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = df.agg(*[F.percentile_approx(v, shares, ACCURACY).alias(f"b{i}") for i, v in enumerate(values)]).first()
    ranks = [rank(v, sorted(set(b or []))) for v, b in zip(values, found)]
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - i))
    return z


def zorder_by(df: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """Partition by ranges of the Z value and sort by it, so that each file covers a narrow range of
    every column. ``df`` is read three times, so it should be a written table. Rows in one cell of
    the curve are told apart by a hash, and copies of one row by their place in the input."""
    keys = {
        "_z": z_value(df, columns),
        "_hash": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
        "_copy": F.monotonically_increasing_id(),
    }
    ranged = df.withColumns(keys).repartitionByRange(partitions, *keys)
    return ranged.sortWithinPartitions("_z", *[F.col(f"`{c}`") for c in columns]).drop(*keys)


def overwrite_zordered(
    df: DataFrame,
    table: str,
    columns: list[str],
    database: str = "default",
    partitions: int | None = None,
    merge_schema: bool = True,
) -> None:
    """Replace a table whose files cover narrow ranges of all ``columns``; see ``zorder_by``. The
    rows are first written as they come, so what is below ``df`` runs once."""
    spark = df.sparkSession
    whole = with_table_schema(df, table, database) if merge_schema else df
    folder = shared_folder(spark)
    whole.write.parquet(folder)
    written = spark.read.schema(whole.schema).parquet(folder)
    publish(zorder_by(written, columns, partitions or file_count(spark, written.count())), table, database)

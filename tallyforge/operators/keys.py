"""Dense surrogate keys without a one-task sort.

``row_number`` over an unpartitioned window pulls the whole table into one task. Here Spark's
range partitioning sorts the rows into partitions in order; the sorted rows are written with
their place, and the number of rows in the partitions before is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.workspace import shared_folder

INT_MAX = 2**31 - 1
# A row's place is its partition, and below that many bits its number in the partition.
PLACE_BITS = 33


def add_dense_key(
    df: DataFrame, name: str, order_by: list[str], key_type: str = "int", partitions: int | None = None
) -> DataFrame:
    """Add ``name``: 1..n in ascending order of ``order_by``, NULLs first.

    Rows with equal ``order_by`` are ordered by a hash of the whole row, so a frequent value is
    spread over several partitions; copies of one row follow their place in the input, which
    spreads them too. ``df`` is read twice, for the sample and for the shuffle, and everything
    after that reads the written rows. ``partitions`` defaults to the session's number.
    """
    spark = df.sparkSession
    input_place = F.monotonically_increasing_id()
    order = [*(F.col(f"`{c}`") for c in order_by), F.col("_hash"), F.col("_copy")]
    rows = df.withColumns({"_hash": F.xxhash64(*df.columns), "_copy": input_place})
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), *order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    folder = shared_folder(spark)
    placed.drop("_hash", "_copy").write.parquet(folder)
    written = spark.read.schema(placed.drop("_hash", "_copy").schema).parquet(folder)

    part = F.shiftright("_place", PLACE_BITS)
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    if key_type == "int" and total > INT_MAX:
        raise ValueError(f"{total} rows need a bigint {name}; pass key_type='bigint'")
    # One row for each partition of the sort, so this window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(before), F.lit(0))
    firsts = sizes.select(F.col("_part"), first.alias("_first"))
    numbered = written.withColumn("_part", part).join(F.broadcast(firsts), "_part")
    number = F.col("_first") + F.col("_place") - F.shiftleft("_part", PLACE_BITS) + 1
    return numbered.select(number.cast(key_type).alias(name), *[F.col(f"`{c}`") for c in df.columns])

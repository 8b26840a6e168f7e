"""What the operators of this subpackage share: written tables, components, blocks of groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.workspace import delete_folder, shared_folder

#: Spark's setting that removes the shuffle files of a query when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: One row in so many is counted to find groups that need cutting.
COUNTED = 32


def stored(df: DataFrame, made: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps never redo its work, and
    a lost executor costs nothing that is already written. The folder is added to ``made``."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    while made:
        delete_folder(spark, made.pop())


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go with the query that wrote them, not when the driver happens to
    collect its garbage. What is returned from inside and runs later is not affected."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and ``text``, a null text as the empty one; other columns only where named."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns)


def text_key(text: Column) -> Column:
    """Tells rows with one id but different texts apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def only_kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``(doc_id, text_key)`` is in ``kept``, with the columns of ``docs``.

    Rows that repeat both id and text are one document: one row of them is returned, the one
    with the smallest hash over its columns, maps left out.
    """
    # The key is one column of one type on both sides, so the join and what follows share a shuffle.
    key = F.struct("doc_id", F.coalesce("text_key", F.lit(0)).alias("text_key"))
    wanted = kept.select(key.alias("_wanted"))
    columns = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    hashed = [columns[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(
        F.struct(*columns.values()).alias("_row"),
        F.xxhash64(*hashed).alias("_rank"),
        F.struct("doc_id", text_key(F.col("text")).alias("text_key")).alias("_key"),
    )
    joined = rows.join(wanted, F.col("_key") == F.col("_wanted"), "left_semi")
    return joined.groupBy("_key").agg(F.min_by("_row", "_rank").alias("_row")).select("_row.*")


def each_copy(rows: DataFrame) -> DataFrame:
    """As many rows as ``copies`` says instead of each, without that column."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return rows.withColumn("copies", copies).drop("copies")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``edges``.

    ``edges`` has two comparable columns ``a`` and ``b``; order, repeats and loops do not matter.
    Large and small stars alternate until there are only stars: every node is the smallest among its
    neighbours, or has a single one. Every round is a written table, all steps are joins and minima
    over edges, and a node with very many edges is an ordinary skewed join key.
    """
    spark = edges.sparkSession
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    old: list[str] = []
    made: list[str] = []
    now = stored(links.distinct(), made)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join reads both sides from a shuffle and a hub's edges can be split.
        lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count("*").alias("n"))
        lows = stored(lows, old)
        open_ = lows.filter("low < u and n > 1").count()
        if not open_:
            discard(spark, old)
            break
        lows = lows.drop("n")
        large = both.filter("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lows, "u").select(
            F.explode(
                F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))
            ).alias("e")
        )
        old, made = old + made, []
        now = stored(small.select("e.*").filter("u <> v").distinct(), made)
        discard(spark, old)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def counted(spread: Column) -> Column:
    """Whether a row is among the one in ``COUNTED`` that sizes of groups are estimated from."""
    return F.pmod(F.shiftright(spread, 32), F.lit(COUNTED)) == 0


def in_blocks(
    rows: DataFrame, key: list[str], spread: Column, limit: int, sample: DataFrame | None = None
) -> DataFrame:
    """Cut groups with over ``limit`` rows into blocks, so that no task holds a whole group.

    Adds ``_i``, ``_j`` and ``_block``. Rows of one ``(key, _i, _j)`` belong together; where
    ``_i`` and ``_j`` differ, rows of block ``_i`` meet those of block ``_j``. Each pair of rows
    of a group meets in exactly one of them. A group of n rows is copied n / limit times.

    Sizes of groups are estimated from one row in ``COUNTED``, chosen by ``spread``. They only
    decide how a group is cut, never whether two of its rows meet. ``sample`` gives the keys of
    those rows where they come cheaper than from ``rows``.
    """
    sample = rows.filter(counted(spread)) if sample is None else sample
    rows = rows.withColumn("_spread", spread)
    big = sample.groupBy(*key).agg(F.ceil(F.count("*") * COUNTED / limit).cast("int").alias("_n"))
    # Written, the few large groups have a known size: while that is small the rows are not
    # shuffled to meet them, and beyond it a large group's partition can be split.
    joined = rows.join(stored(big.filter("_n > 1")), key, "left")
    block = F.pmod(F.col("_spread"), F.coalesce("_n", F.lit(1))).cast("int")
    joined = joined.withColumn("_block", block)
    partners = F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1)
    met = joined.withColumn("_other", F.explode(partners))
    return met.select(
        *[c for c in rows.columns if c != "_spread"],
        F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"),
        "_block",
    )


def grouped(batches: Iterable[pa.RecordBatch], same: list[str], least: int) -> Iterator[pa.Table]:
    """Tables of at least ``least`` rows from sorted batches, never cutting a run of rows that
    agree in the columns ``same``. A cut falls where the last run of a batch begins."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows >= least:
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table[c][-1].as_py() for c in same]
            first = [batch.column(c)[0].as_py() for c in same]
            if first != last:
                yield table
                held, rows = [], 0
            else:
                cut = run_start(table, same)
                if cut:
                    yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_start(table: pa.Table, same: list[str]) -> int:
    """Index of the first row of the last run."""
    import numpy as np

    differs = np.zeros(table.num_rows, dtype=bool)
    for name in same:
        values = table[name].to_numpy()
        differs[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(differs)
    return int(starts[-1]) if len(starts) else 0


def local_roots(roots, a, b):
    """Merge the links ``a`` - ``b`` into ``roots``, an array that maps rows to the smallest row
    they are linked to."""
    import numpy as np

    while len(a):
        ra, rb = roots[a], roots[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b = ra[differ], rb[differ]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = roots[roots]
            if np.array_equal(jumped, roots):
                break
            roots = jumped
    return roots

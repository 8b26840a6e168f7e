"""Exact duplicates by deterministic block naming, with DataFrame operations only.

A text is cut into blocks of a fixed number of bytes. Equal blocks get one name; then the names
of adjacent blocks are paired, and equal pairs get one name again, until every document has a
single name. Names are given to contents, not to hashes of them, so two documents share a name
at the same number of blocks exactly when their texts are identical byte by byte.

The first names are the smallest occurrence of a block, a value that does not depend on how
the data are partitioned; the later ones are integers that number the sorted, distinct pairs
and are written before they are used. The text itself is shuffled for the first naming only.

Results for special rows: a null text counts as empty, and empty texts equal one another. Rows
that repeat both id and text are named as one document, count each in the size of its group, and
are a row of the result each; the stage keeps one. Rows with one id and different texts are
separate documents. A null id is smaller than any other. A very long text is read as blocks from
its row, which a task holds whole, and no later step has more of it than a block. An empty table
gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import each_copy, only_kept, stored, text_key, texts_of

BLOCK_BYTES = 4096


def documents_with_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text's bytes, its key, and its SHA-256 as bytes, which with the id tells
    documents apart."""
    rows = texts_of(docs)
    return rows.select(
        "doc_id",
        text_key(F.col("text")).alias("text_key"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.col("text").cast("binary").alias("content"),
    )


def text_blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block; an empty text has one empty block."""
    size = F.octet_length("content")
    count = F.greatest(F.lit(1), F.ceil(size / block_bytes).cast("int"))
    numbered = rows.withColumn("blocks", count).withColumn(
        "number", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    block = F.substring(F.col("content"), F.col("number") * block_bytes + 1, F.lit(block_bytes))
    return numbered.select("doc_id", "text_key", "digest", "blocks", "number", block.alias("block"))


def name_blocks(blocks: DataFrame, salts: int) -> DataFrame:
    """``name`` of every block: the first of its occurrences in order of id, digest and place.

    A block may be very frequent, so the first occurrence is found among those of equal salt,
    and then among the firsts of the salts. With the square root of the rows as ``salts`` no
    group of either step is larger than about that.
    """
    # Everything about a row is in its place, so both uses of the rows need the same columns
    # and share one shuffle of the blocks.
    place = F.struct("doc_id", "digest", "number", "text_key", "blocks")
    salted = blocks.select(place.alias("place"), "block")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(salts)))
    rows = salted.withColumn("near", F.min("place").over(Window.partitionBy("block", "salt")))
    firsts = rows.filter("place = near").select("near", "block")
    names = firsts.withColumn("name", F.min("near").over(Window.partitionBy("block")))
    names = names.select(F.col("near").alias("_near"), "name").distinct()
    return rows.join(names, F.col("near") == F.col("_near")).select("place.*", "name")


def name_integers(rows: DataFrame, parts: list[str]) -> DataFrame:
    """Replace the columns ``parts`` by ``name``, an integer that numbers their sorted, distinct
    values. The numbers are written first, so a task that runs again sees the same ones."""
    distinct = rows.select(*[F.col(p).alias(f"_was_{p}") for p in parts]).distinct()
    ordered = distinct.repartition(*distinct.columns).sortWithinPartitions(*distinct.columns)
    names = stored(ordered.withColumn("_name", F.monotonically_increasing_id()))
    same = [F.col(p).eqNullSafe(F.col(f"_was_{p}")) for p in parts]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    others = [c for c in rows.columns if c not in parts]
    return rows.join(names, condition).select(*others, F.col("_name").alias("name"))


def name_pairs(level: DataFrame) -> DataFrame:
    """Name pairs of adjacent names; a last one without a neighbour is paired with null."""
    place = F.floor(F.col("number") / 2).cast("int")
    first = F.min(F.when(F.col("number") % 2 == 0, F.col("name")))
    second = F.min(F.when(F.col("number") % 2 == 1, F.col("name")))
    keys = ["doc_id", "text_key", "digest", "blocks"]
    pairs = level.groupBy(*keys, place.alias("number")).agg(first.alias("left"), second.alias("right"))
    return name_integers(pairs, ["left", "right"])


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``text_key``, ``digest`` and the identity (``blocks``, ``name``) of each
    distinct (id, text), with ``copies``, the number of rows it stands for."""
    blocks = text_blocks(documents_with_digest(docs), block_bytes)
    # A row that repeats id and text repeats its blocks; they are counted on the first block.
    keys = ["doc_id", "text_key", "digest", "blocks", "number", "name"]
    salts = 1 + math.isqrt(docs.count())
    named = stored(name_blocks(blocks, salts).groupBy(*keys).agg(F.count("*").alias("copies")))
    copies = named.filter("number = 0").select("doc_id", "digest", "copies")
    level = stored(name_integers(named.drop("copies"), ["name"]))
    longest = level.agg(F.max("blocks")).first()[0] or 1
    done = level.filter("blocks = 1")
    width = 1
    while width < longest:
        # A document of this many blocks is one name after this round, and leaves.
        level = stored(name_pairs(level.filter(F.col("blocks") > width)))
        done = done.unionByName(level.filter(F.col("blocks") <= 2 * width).select(*done.columns))
        width *= 2
    done = done.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return copies.join(done, same).select("doc_id", "text_key", "digest", "blocks", "name", "copies")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``text_key`` of every row.

    Of documents with equal texts the one with the largest id stays.
    """
    return each_copy(distinct_duplicates(docs, block_bytes))


def distinct_duplicates(docs: DataFrame, block_bytes: int) -> DataFrame:
    """The same for each distinct (id, text), with ``copies``, the rows it stands for."""
    rows = stored(identities(docs, block_bytes))
    groups = rows.groupBy(F.col("blocks").alias("_blocks"), F.col("name").alias("_name")).agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    groups = stored(groups)
    same = (F.col("blocks") == F.col("_blocks")) & (F.col("name") == F.col("_name"))
    return rows.join(groups, same).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        kept(F.col("doc_id"), F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_key",
        "copies",
    )


def kept(doc_id: Column, keep_id: Column) -> Column:
    return doc_id.eqNullSafe(keep_id)


def drop_exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one document of each group of equal texts, columns unchanged."""
    return only_kept(docs, distinct_duplicates(docs, block_bytes).filter("kept"))

"""Near-duplicate documents by SimHash fingerprints, compared in bit-sliced blocks.

Fingerprints that differ in at most ``max_bits`` bits share at least ``chosen`` of the
``max_bits + chosen`` pieces a fingerprint is cut into, whichever bits differ. So every choice
of ``chosen`` pieces is a table of buckets, and the links are exactly those found inside
buckets. In a bucket the bits are stored vertically, one plane per bit with 64 fingerprints in
a word. A query's differences are added plane by plane into carry-save counters, 64 distances
at a time, and a word whose distances have all passed the limit is abandoned.

Results for special rows: a null text counts as empty, and a text without words has fingerprint
zero, which links like any other. Rows that repeat both id and text are a row of the result each;
the stage keeps one. Rows with one id and different texts are separate documents. A null id takes
part but never names a component while the component has another id. A very long text is hashed
in slices of its shingles; a task holds the text, its words and their places. An empty table gives
an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import (
    connected_components,
    each_copy,
    grouped,
    in_blocks,
    local_roots,
    only_kept,
    stored,
    text_key,
    texts_of,
)

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Unrelated fingerprints wanted in a bucket.
BUCKET_ROWS = 64
#: Rows of a block; a bucket with more is compared block by block.
BLOCK_ROWS = 4096
SLAB_ROWS = 65_536
WORDS_AT_ONCE = 32_768
HASHES_AT_ONCE = 65_536
ALL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)


# --- fingerprints -------------------------------------------------------------------------


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the shingles of a text, each occurrence counted."""
    words = text.lower().split()  # bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words))
    total = len(words) - span + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, HASHES_AT_ONCE):
        upto = min(at + HASHES_AT_ONCE, total)
        pairs = zip(starts[at:upto].tolist(), ends[at + span - 1 : upto + span - 1].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in pairs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    set_bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_key`` and the fingerprint ``fp`` as a bigint with the same bits."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column("text").cast(pa.large_binary())
            prints = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], dtype=np.uint64)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_key", "fp"],
            )

    rows = texts_of(docs).select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, text_key bigint, fp bigint")


# --- links --------------------------------------------------------------------------------


def piece_masks(max_bits: int, chosen: int) -> list[int]:
    """One mask per choice of pieces."""
    pieces = max_bits + chosen
    edges = [round(64 * i / pieces) for i in range(pieces + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(masks, chosen)]


def pieces_to_agree(prints: int, max_bits: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Fewest pieces to join on that leave about ``bucket_rows`` unrelated fingerprints in a
    bucket: more pieces make smaller buckets and more tables, and the links are the same."""
    chosen = 1
    while prints / 2.0 ** (64 * chosen / (max_bits + chosen)) > bucket_rows:
        chosen += 1
    return chosen


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words; lane r of a row's words is that bit of fingerprint r."""
    lanes = -(-len(prints) // 64) * 64
    bits = np.zeros((lanes, 64), dtype=np.uint8)
    as_bytes = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
    bits[: len(prints)] = np.unpackbits(as_bytes, axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")


def beyond(counters: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose count, held in vertical bits, is over ``limit``."""
    over, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for k in reversed(range(len(counters))):
        if limit >> k & 1:
            equal &= counters[k]
        else:
            over |= equal & counters[k]
            equal &= ~counters[k]
    return over


def close_pairs(
    prints: np.ndarray, low: np.ndarray, high: np.ndarray, max_bits: int = MAX_BITS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query row, target row) at ``max_bits`` or fewer bits; row r is compared with the
    rows from ``low[r]`` up to ``high[r]``."""
    planes = bit_planes(prints)
    queries = np.flatnonzero(high > low)
    first, last = low[queries] >> 6, (high[queries] - 1) >> 6
    ends = np.cumsum(last - first + 1)
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total, WORDS_AT_ONCE):
        task = np.arange(at, min(at + WORDS_AT_ONCE, total))
        own = np.searchsorted(ends, task, side="right")
        query = queries[own]
        word = last[own] - (ends[own] - 1 - task)
        begin = np.maximum(low[query] - 64 * word, 0).astype(np.uint64)
        count = np.minimum(high[query] - 64 * word, 64).astype(np.uint64) - begin
        passed = ~((ALL >> (np.uint64(64) - count)) << begin)
        counters = [np.zeros(len(task), dtype=np.uint64) for _ in range(max(1, max_bits.bit_length()))]
        for bit in range(64):
            flip = np.uint64(0) - ((prints[query] >> np.uint64(bit)) & np.uint64(1))
            carry = planes[bit][word] ^ flip
            for k, counter in enumerate(counters):
                counters[k], carry = counter ^ carry, counter & carry
            passed |= carry
            if bit % 4 == 3:
                passed |= beyond(counters, max_bits)
                open_ = np.flatnonzero(passed != ALL)
                if not len(open_):
                    break
                if len(open_) < 0.8 * len(passed):
                    query, word, passed = query[open_], word[open_], passed[open_]
                    counters = [c[open_] for c in counters]
        hits = ~passed
        found = np.flatnonzero(hits)
        if len(found):
            lanes = np.unpackbits(
                hits[found].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            which, lane = np.nonzero(lanes)
            yield query[found[which]], word[found[which]] * 64 + lane


def run_windows(
    same: np.ndarray, block: np.ndarray, two: np.ndarray | bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """``low`` and ``high`` of each row's targets, for rows sorted by run and block: the later
    rows of its run, or where ``two`` blocks are to meet, for rows of the first all of the second."""
    n = len(same)
    new_run = np.concatenate(([True], same[1:] != same[:-1]))
    new_block = new_run | np.concatenate(([True], block[1:] != block[:-1]))
    starts = np.flatnonzero(new_run)
    run = np.cumsum(new_run) - 1
    end = np.concatenate((starts[1:], [n]))[run]
    block_start = np.maximum.accumulate(np.where(new_block, np.arange(n), 0))
    block_end = np.concatenate((np.flatnonzero(new_block)[1:], [n]))[np.cumsum(new_block) - 1]
    low = np.where(two, block_end, np.arange(n) + 1)
    return low, np.where(two & (block_start > starts[run]), low, end)


def spanning_links(
    prints: np.ndarray, same: np.ndarray, block: np.ndarray, two: np.ndarray | bool, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is close within each run of ``same``; at most one per row."""
    low, high = run_windows(same, block, two)
    rows = np.arange(len(prints))
    roots = rows.copy()
    for a, b in close_pairs(prints, low, high, max_bits):
        roots = local_roots(roots, a, b)
    moved = np.flatnonzero(roots != rows)
    return moved, roots[moved]


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, chosen: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that join everything within reach.

    ``chosen`` pieces agree in a bucket, by default as many as the number of fingerprints asks for.
    Inside a bucket only as many links are given as it takes to connect what is close, so a
    group of n close fingerprints gives n - 1 links per bucket and not a link per pair.
    """
    chosen = chosen or pieces_to_agree(prints.count(), max_bits)
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("bucket"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("bits"))
            for t, mask in enumerate(piece_masks(max_bits, chosen))
        ]
    )
    rows = prints.select("fp", F.explode(tables).alias("t")).select("t.*", "fp")
    return bucket_links(rows, ["bucket", "bits"], max_bits, block_rows)


def bucket_links(rows: DataFrame, bucket: list[str], max_bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that join the fingerprints ``fp`` within reach in each ``bucket``."""
    blocks = in_blocks(rows, bucket, F.xxhash64("fp"), block_rows)
    keys = [*bucket, "_i", "_j"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(source, keys, SLAB_ROWS):
            columns = [table[c].to_numpy() for c in keys]
            change = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
            same = np.concatenate(([0], np.cumsum(change)))
            fp = table["fp"].to_numpy()
            block, two = table["_block"].to_numpy(), columns[-2] != columns[-1]
            rows, roots = spanning_links(fp.view(np.uint64), same, block, two, max_bits)
            yield pa.record_batch([pa.array(fp[rows]), pa.array(fp[roots])], names=["a", "b"])

    together = blocks.repartition(*keys).sortWithinPartitions(*keys, "_block", "fp")
    return together.mapInArrow(batches, "a bigint, b bigint")


# --- the operator -------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    chosen: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``text_key`` and ``kept`` of
    every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links. ``kept`` marks one document
    of each component, the one it is named after (of several texts with that id, the one with
    the smallest key), and all rows that repeat it.
    """
    return each_copy(distinct_near_duplicates(docs, shingle_words, max_bits, chosen, block_rows))


def distinct_near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    chosen: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The same for each distinct (id, text), with ``copies``, the rows it stands for."""
    rows = with_fingerprints(docs, shingle_words)
    prints = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key")))
    unnamed = F.min(F.when(F.col("doc_id").isNull(), F.struct("doc_id", "text_key")))
    distinct = stored(prints.groupBy("fp").agg(F.coalesce(first, unnamed).alias("low")))
    parts = stored(
        connected_components(links(distinct.select("fp"), max_bits, chosen, block_rows)).withColumnRenamed("node", "fp")
    )
    named = F.min(F.when(F.col("low.doc_id").isNotNull(), F.col("low")))
    lows = parts.join(distinct, "fp").groupBy("component")
    lows = stored(lows.agg(F.coalesce(named, F.min("low")).alias("lowest")))
    moved = parts.join(lows, "component").select("fp", "lowest")
    labels = stored(
        distinct.join(moved, "fp", "left").select("fp", F.coalesce("lowest", "low").alias("lowest"))
    )
    own = F.struct("doc_id", "text_key")
    return prints.join(labels, "fp").select(
        "doc_id",
        hex_digits(F.col("fp")).alias("fingerprint"),
        F.col("lowest.doc_id").alias("component_id"),
        "text_key",
        own.eqNullSafe(F.col("lowest")).alias("kept"),
        "copies",
    )


def hex_digits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, columns unchanged."""
    return only_kept(docs, distinct_near_duplicates(docs, **options).filter("kept"))

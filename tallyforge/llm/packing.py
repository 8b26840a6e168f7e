"""Best-fit packing of documents into sequences of several permitted lengths.

A document's length is its number of tokens. A document longer than the longest capacity is cut
into full pieces and a rest, so nothing is lost. Pieces are packed in order of falling length,
each into the open bin it fills best. Where none has room a bin is opened, of the capacity that
costs least per token it can hold or, if the plan is ``joint``, per token it would be given: each
capacity is filled on trial from the shorter pieces that no bin opened before counts on. At the
end every bin shrinks to the smallest capacity that holds its contents. As later pieces need not
go where a trial put them, ``pack`` with ``joint`` makes both plans and takes the cheaper one.

Pieces of one length are interchangeable, and so are bins with one history. The decisions are
therefore made on the histogram of lengths, which has at most as many rows as the longest
capacity however large the data are: a step puts pieces of one length into all bins of one
history at once. The result is a list of ranges of ranks ("pieces 4,000 to 8,999 of length 812
go into bins 100 to 5,099"), as long as the plan needs and independent of the number of
documents. Ranks within a length are counted in parallel, in shares of bounded size, and every
piece looks its bin up in the broadcast ranges.

Results for special rows: a null text counts as empty. An empty text has the length of its end
mark. Repeated rows are packed each, told apart by ``copy``. A null id is packed like any other.
An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import stored, texts_of

#: Permitted sequence lengths, in tokens of a byte-level model.
CAPACITIES = (2048, 4096, 8192, 16384)
#: Cost of a sequence: a fixed share, one per token, and attention's share that grows squared.
FIXED_COST = 256.0
SQUARE_COST = 1 / 32768
#: Pieces ranked together in one share.
SHARE_ROWS = 100_000
COPIES_AT_ONCE = 10_000


class Span(NamedTuple):
    """Pieces ``rank``, ``rank + 1``, ... of ``length`` go one each into the ``bins`` bins from
    ``bin`` on, at ``offset``."""

    length: int
    rank: int
    bins: int
    bin: int
    offset: int


class Bins(NamedTuple):
    """Bins with one history, numbered from ``bin`` on."""

    bin: int
    bins: int
    opened: int
    used: int


def byte_tokens(text: Column) -> Column:
    """Tokens of a byte-level model: one per byte of UTF-8, and an end mark."""
    return F.octet_length(text) + 1


def sequence_cost(capacity: int) -> float:
    return FIXED_COST + capacity + SQUARE_COST * capacity * capacity


def on_trial(free: np.ndarray, length: int, left: int, size: int) -> tuple[int, list[tuple[int, int]]]:
    """Tokens in each of the bins of ``size`` that ``left`` pieces of ``length`` open at once, and
    how many of which shorter ``free`` pieces fill them all alike, the longest first."""
    each = min(left, size // length)
    bins = left // each
    room = size - each * length
    lengths = np.flatnonzero(free[: min(length, room + 1)] >= bins).tolist()
    taken = []
    upto = len(lengths)
    while upto := bisect_right(lengths, room, hi=upto):
        upto -= 1
        shorter = lengths[upto]
        each = min(room // shorter, int(free[shorter]) // bins)
        taken.append((shorter, each * bins))
        room -= each * shorter
    return size - room, taken


def plan(
    counts: dict[int, int], capacities: Sequence[int], cost: Callable[[int], float], joint: bool = False
) -> tuple[list[Span], list[Bins]]:
    """Where every rank of every length goes, and the closed bins, from the histogram alone."""
    sizes = sorted(capacities)
    free = np.zeros(max(counts, default=0) + 1, dtype=np.int64)
    free[list(counts)] = list(counts.values())
    spans: list[Span] = []
    # Open bins by (room, number), so that the best fit is the first one with enough room.
    open_: list[tuple[int, int, Bins]] = []
    closed: list[Bins] = []
    made = 0

    def keep(group: Bins) -> None:
        room = group.opened - group.used
        if room:
            insort(open_, (room, group.bin, group))
        else:
            closed.append(group)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        fitting = [c for c in sizes if c >= length]
        size = min(fitting, key=lambda c: (cost(c) / c, c))
        while left:
            at = bisect_left(open_, (length,))
            if at < len(open_):
                group = open_.pop(at)[2]
            else:
                if joint:
                    trials = {c: on_trial(free, length, left, c) for c in fitting}
                    size = min(fitting, key=lambda c: (cost(c) / trials[c][0], c))
                    for shorter, taken in trials[size][1]:
                        free[shorter] -= taken
                # All bins the rest can open at once, each to hold as many as fit one.
                each = size // length
                full = left // each
                group = Bins(made, max(1, full), size, 0)
                made += group.bins
            # One after another, bins of one history fill up with this length, the fuller first.
            each = (group.opened - group.used) // length
            full = min(group.bins, left // each)
            if full and full < group.bins:
                keep(Bins(group.bin + full, group.bins - full, group.opened, group.used))
            elif not full:
                if group.bins > 1:
                    keep(Bins(group.bin + 1, group.bins - 1, group.opened, group.used))
                full, each = 1, left
            for slot in range(each):
                spans.append(Span(length, rank, full, group.bin, group.used + slot * length))
                rank += full
            left -= full * each
            keep(Bins(group.bin, full, group.opened, group.used + each * length))
    return spans, closed + [group for *_, group in open_]


def shrunk(group: Bins, sizes: Sequence[int]) -> int:
    return min(c for c in sizes if c >= group.used)


def cheaper_plan(
    counts: dict[int, int], capacities: Sequence[int], cost: Callable[[int], float]
) -> tuple[list[Span], list[Bins]]:
    """Of the joint plan and the other, the one whose bins cost less once they have shrunk."""
    plans = [plan(counts, capacities, cost, joint) for joint in (True, False)]
    return min(plans, key=lambda found: sum(g.bins * cost(shrunk(g, capacities)) for g in found[1]))


def pieces_of(docs: DataFrame, length: Callable[[Column], Column], longest: int) -> DataFrame:
    """``doc_id``, ``copy``, ``piece``, ``start`` and ``length`` in tokens, one row per piece."""
    sized = texts_of(docs).select("doc_id", F.xxhash64("text").alias("mark"), length(F.col("text")).alias("size"))
    # Rows that repeat id and text are counted before they meet, so many copies make no hot group.
    counted = sized.groupBy("doc_id", "mark", "size").agg(F.count("*").alias("copies"))
    chunk = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(COPIES_AT_ONCE).cast("bigint")))
    upto = F.least(F.col("copies"), F.col("_first") + COPIES_AT_ONCE - 1)
    copies = counted.withColumn("_first", chunk).withColumn("copy", F.explode(F.sequence("_first", upto)))
    count = F.greatest(F.lit(1), F.ceil(F.col("size") / longest)).cast("int")
    cut = copies.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    start = F.col("piece").cast("bigint") * longest
    rest = F.least(F.lit(longest), F.col("size") - start).cast("int")
    return cut.select("doc_id", "mark", "copy", "piece", start.alias("start"), rest.alias("length"))


def ranked(pieces: DataFrame, counts: dict[int, int], share_rows: int) -> DataFrame:
    """Add ``rank``, from 0, among the pieces of one length.

    A length may be that of very many pieces. They are dealt into shares by a hash, each share
    is numbered on its own, and the shares before it are added.
    """
    shares = {n: math.ceil(c / share_rows) for n, c in counts.items() if c > share_rows}
    spark = pieces.sparkSession
    # One row for each length with over share_rows pieces, at most the longest capacity.
    known = F.broadcast(spark.createDataFrame(list(shares.items()), "length int, shares int"))
    hashed = F.xxhash64("doc_id", "mark", "copy", "piece")
    dealt = pieces.join(known, "length", "left").withColumn(
        "share", F.pmod(hashed, F.coalesce("shares", F.lit(1))).cast("int")
    )
    dealt = stored(dealt.drop("shares"))
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    # One row per length and share: a share_rows-th of the pieces, and one per length.
    firsts = sizes.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("length", "share").orderBy("doc_id", "mark", "copy", "piece")
    numbered = dealt.withColumn("_number", F.row_number().over(order) - 1)
    return numbered.join(firsts, ["length", "share"]).withColumn("rank", F.col("first") + F.col("_number"))


def pack(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    length: Callable[[Column], Column] = byte_tokens,
    cost: Callable[[int], float] = sequence_cost,
    share_rows: int = SHARE_ROWS,
    joint: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``copy``, ``piece``, its ``start`` and ``length`` within
    the document, and ``bin_id``, ``bin_offset``, ``bin_capacity``, ``bin_used``."""
    longest = max(capacities)
    pieces = stored(pieces_of(docs, length, longest))
    # At most `longest` rows: a length is between 1 and the longest capacity.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    spans, groups = (cheaper_plan if joint else plan)(counts, capacities, cost)
    by_bin = sorted((g.bin, g.used, shrunk(g, capacities)) for g in groups)
    table = np.array(sorted(spans), dtype=np.int64).reshape(-1, 5)
    bins = np.array(by_bin, dtype=np.int64).reshape(-1, 3)
    shared = docs.sparkSession.sparkContext.broadcast((table, bins))
    rows = ranked(pieces, counts, share_rows)
    rows = rows.select("doc_id", "copy", "piece", "start", "length", "rank")
    kind = dict(rows.dtypes)["doc_id"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bins = shared.value
        for batch in source:
            sizes = batch.column("length").to_numpy().astype(np.int64)
            ranks = batch.column("rank").to_numpy()
            span = table[position(table[:, 0], table[:, 1], sizes, ranks)] if len(sizes) else table[:0]
            bin_id = span[:, 3] + (ranks - span[:, 1])
            group = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1] if len(sizes) else bins[:0]
            added = [bin_id, span[:, 4], group[:, 2], group[:, 1]]
            names = ["doc_id", "copy", "piece", "start", "length"]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), *(pa.array(a) for a in added)],
                names=[*names, "bin_id", "bin_offset", "bin_capacity", "bin_used"],
            )

    schema = f"doc_id {kind}, copy bigint, piece int, start bigint, length int"
    added = "bin_id bigint, bin_offset bigint, bin_capacity bigint, bin_used bigint"
    return rows.mapInArrow(batches, f"{schema}, {added}")


def position(lengths: np.ndarray, firsts: np.ndarray, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Row of the last span of ``length`` that starts at or before ``rank``."""
    wide = np.int64(max(int(firsts.max()), int(rank.max())) + 1)
    return np.searchsorted(lengths * wide + firsts, length.astype(np.int64) * wide + rank, side="right") - 1

"""How text filters overlap: what each removes, alone and after others, in every order.

A document fails up to five filters: (A) too few words, (B) too few distinct words, (C) too many
capitals, (D) signs of markup, (E) the same text as a document with a smaller id. Which ones is
its mask. E is decided in radix tries: a task puts the texts it reads into compressed tries of
bounded size, so that of the copies it holds one text goes on, with their smallest id. These
texts are range-partitioned by prefixes that are as long as it takes for the texts behind one to
fit a task, and put into tries again, whose terminals hold the smallest id and the local groups
that end there. Every group learns that id, and a document with a larger one fails E. The report
needs no more than the number of documents of each part and mask.

Results for special rows: a null text counts as empty, and an empty text has no words: it fails
A alone, and E where it is repeated. A null source is the part with the empty name, along with
the empty source. Rows that repeat an id are documents of their own; those with the smallest id
among copies pass E, all of them. A null id is larger than none: it passes E and makes no other
fail. A label's id may repeat: one good or toxic label makes a document so. Words of very long
texts are counted piece by piece; a task holds the text, its distinct words and tries of
``TRIE_BYTES`` besides. Empty documents give an empty report. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import stored

FILTERS = "ABCDE"
FEW_WORDS, FEW_DISTINCT, CAPITALS, SIGNS, REPEATED = (1 << i for i in range(5))

LEAST_WORDS = 200
#: Shares in hundredths: least of distinct words, most of capitals.
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKUP = b"#$%&*|"

UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: UTF-8 bytes that do not begin a code point.
FOLLOWING = bytes(range(0x80, 0xC0))
WHITE = re.compile(rb"[\x20\x09-\x0D]")
PIECE_BYTES = 1 << 24

#: Text bytes after which a trie is given up for a new one, and those that may share a prefix.
TRIE_BYTES = 1 << 24
#: Text bytes of a prefix that are never worth a longer one.
LEAST_SHARE = 1 << 16
#: Rows of one trie before it is given up, however few texts they have; rows of a batch that is sent on.
ROWS_HELD = 1 << 18
ROWS_AT_ONCE = 4096
#: Bytes of the shortest prefix. A crowded one becomes ``LONGER`` times as long.
HEAD_BYTES = 16
LONGER = 8
#: A group's name is the task's number, and below that many bits its number in the task.
NAME_BITS = 33


# --- the four filters on one text ---------------------------------------------------------


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that cut no word."""
    at = 0
    while at + size < len(text):
        cut = WHITE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def text_mask(text: bytes) -> int:
    """Which of the filters A to D a text in UTF-8 fails."""
    count, distinct = 0, set()
    for piece in pieces(text):
        words = piece.split()  # bytes: at the six ASCII white-space characters
        count += len(words)
        distinct.update(words)
    points = len(text.translate(None, FOLLOWING))
    capitals = len(text) - len(text.translate(None, UPPER))
    return (
        FEW_WORDS * (count < LEAST_WORDS)
        | FEW_DISTINCT * (100 * len(distinct) < LEAST_DISTINCT * count)
        | CAPITALS * (100 * capitals > MOST_CAPITALS * points)
        | SIGNS * (len(text) > len(text.translate(None, MARKUP)))
    )


# --- tries --------------------------------------------------------------------------------


class Node:
    """A place in a trie: the edges onwards by their first byte, and what ends here."""

    __slots__ = ("edges", "terminal")

    def __init__(self) -> None:
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.terminal: Terminal | None = None


class Terminal:
    """The smallest id of the rows whose text ends here, and the names they go by."""

    __slots__ = ("low", "names", "mask")

    def __init__(self) -> None:
        self.low: object = None
        self.names: list[int] = []
        self.mask = 0

    def saw(self, doc_id: object) -> None:
        if doc_id is not None and (self.low is None or doc_id < self.low):
            self.low = doc_id


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A radix trie of whole texts; a chain of places without a branch is one edge."""

    def __init__(self) -> None:
        self.root = Node()
        self.bytes = 0

    def terminal(self, text: bytes) -> Terminal:
        """The terminal of ``text``, which is put in if it is new."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = (text[at:], leaf)
                self.bytes += len(text) - at
                node, at = leaf, len(text)
            elif text.startswith(edge[0], at):
                node, at = edge[1], at + len(edge[0])
            else:
                label, below = edge
                same = shared_length(label, text[at : at + len(label)])
                fork = Node()
                fork.edges[label[same]] = (label[same:], below)
                node.edges[text[at]] = (label[:same], fork)
                node, at = fork, at + same
        if node.terminal is None:
            node.terminal = Terminal()
            self.bytes += 1
        return node.terminal

    def terminals(self) -> Iterator[Terminal]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.terminal is not None:
                yield node.terminal
            waiting.extend(below for _, below in node.edges.values())


# --- which documents repeat a text ----------------------------------------------------------


def local_groups(docs: DataFrame, trie_bytes: int = TRIE_BYTES, rows_held: int = ROWS_HELD) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of A to D and ``name``, the group of equal texts that a task
    read close together, of every row. The first row of a group also has its smallest id ``low``,
    its ``text``, the ``head`` of it and its ``size``."""
    kind = dict(docs.dtypes)["doc_id"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << NAME_BITS
        trie, ids, parts, ends, texts = Trie(), [], [], [], []

        def rows(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(ids), ROWS_AT_ONCE):
                cut = slice(at, at + ROWS_AT_ONCE)
                new = [t is not None for t in texts[cut]]
                columns = {
                    "doc_id": pa.array(ids[cut], id_type),
                    "part": pa.array(parts[cut], pa.string()),
                    "name": pa.array([e.names[0] for e in ends[cut]], pa.int64()),
                    "mask": pa.array([e.mask for e in ends[cut]], pa.int32()),
                    "low": pa.array([e.low if n else None for e, n in zip(ends[cut], new)], id_type),
                    "text": pa.array(texts[cut], pa.binary()),
                    "head": pa.array([t if t is None else t[:HEAD_BYTES] for t in texts[cut]], pa.binary()),
                    "size": pa.array([t if t is None else len(t) for t in texts[cut]], pa.int64()),
                }
                yield pa.record_batch(list(columns.values()), names=list(columns))

        for batch in source:
            id_type = batch.schema.field("doc_id").type
            held = batch.column("text").cast(pa.large_binary())
            for doc_id, part, value in zip(batch.column("doc_id"), batch.column("part"), held):
                if trie.bytes > trie_bytes or len(ids) >= rows_held:
                    yield from rows(id_type)
                    trie, ids, parts, ends, texts = Trie(), [], [], [], []
                text = value.as_py()
                end = trie.terminal(text)
                new = not end.names
                if new:
                    end.names.append(made)
                    end.mask = text_mask(text)
                    made += 1
                ids.append(doc_id.as_py())
                end.saw(ids[-1])
                parts.append(part.as_py())
                ends.append(end)
                texts.append(text if new else None)
        if ids:
            yield from rows(id_type)

    part, text = F.coalesce("source", F.lit("")), F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", part.alias("part"), text.alias("text"))
    schema = f"doc_id {kind}, part string, name bigint, mask int, low {kind}, text binary, head binary, size bigint"
    return rows.mapInArrow(batches, schema)


def head_of(width: int) -> Column:
    return F.col("head") if width == HEAD_BYTES else F.substring("text", 1, width)


def with_prefix(texts: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """Adds ``prefix``: the first bytes of the text, as many as it takes until the texts that share
    them have at most ``limit`` bytes together, or are one text.

    The prefixes of a width that are crowded are a written table, so that Spark knows its size
    when it joins it; there are at most as many as the texts have times ``limit`` bytes.
    """
    width, crowded = HEAD_BYTES, []
    inside, prefix = texts, F.col("head")
    while True:
        groups = inside.groupBy(head_of(width).alias("at"))
        sizes = groups.agg(F.sum("size").alias("total"), F.max("size").alias("most"))
        found = stored(sizes.filter((F.col("total") > limit) & (F.col("most") > width)).select("at"))
        if found.isEmpty():
            break
        at = f"_at{width}"
        crowded.append((width, at, found.withColumnRenamed("at", at)))
        inside = inside.join(crowded[-1][2], head_of(width) == F.col(at), "left_semi")
        width *= LONGER
    for wide, at, found in crowded:
        texts = texts.join(found, head_of(wide) == F.col(at), "left")
        prefix = F.when(F.col(at).isNotNull(), head_of(wide * LONGER)).otherwise(prefix)
    return texts.withColumn("prefix", prefix).drop(*[at for _, at, _ in crowded])


def smallest_ids(groups: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``name`` and ``low``, the smallest id with the text of that group, of written groups.

    The texts of a range come sorted by prefix. Once a trie holds ``trie_bytes`` it is traversed
    and given up before the first text of another prefix, so a task never holds more than that
    and the texts of one prefix.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last, id_type = Trie(), None, None

        def lows() -> Iterator[pa.RecordBatch]:
            names, low = [], []
            for end in trie.terminals():
                names += end.names
                low += [end.low] * len(end.names)
            yield pa.record_batch([pa.array(names, pa.int64()), pa.array(low, id_type)], names=["name", "low"])

        for batch in source:
            id_type = batch.schema.field("low").type
            for row in zip(*[batch.column(c) for c in ("prefix", "text", "name", "low")]):
                prefix, text, name, low = (value.as_py() for value in row)
                if trie.bytes > trie_bytes and prefix != last:
                    yield from lows()
                    trie = Trie()
                last = prefix
                end = trie.terminal(text)
                end.names.append(name)
                end.saw(low)
        if last is not None:
            yield from lows()

    texts = groups.filter(F.col("text").isNotNull()).select("name", "low", "text", "head", "size")
    # No prefix is to have more than a task's share, or ranges could not be even.
    partitions = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = (texts.agg(F.sum("size")).first()[0] or 0) // partitions
    rows = with_prefix(texts, min(trie_bytes, max(share, LEAST_SHARE))).select("name", "low", "text", "prefix")
    ranged = rows.repartitionByRange("prefix").sortWithinPartitions("prefix")
    return ranged.mapInArrow(batches, f"name bigint, low {dict(groups.dtypes)['low']}")


def document_masks(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``doc_id``, ``part`` and ``mask``, the filters it fails, of every row of ``docs``."""
    groups = stored(local_groups(docs, trie_bytes))
    rows = groups.select("doc_id", "part", "mask", "name").join(smallest_ids(groups, trie_bytes), "name")
    repeated = F.coalesce(F.col("doc_id") > F.col("low"), F.lit(False)).cast("int") * REPEATED
    return rows.select("doc_id", "part", F.col("mask").bitwiseOR(repeated).alias("mask"))


# --- the report -----------------------------------------------------------------------------


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` and the documents ``n`` with it, those labelled ``good`` and ``toxic``."""
    # Counted first, so that an id or a lack of one that very many rows share is few rows.
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    of_quality, of_toxic = F.max(F.col("quality") == 1), F.max(F.col("toxic") == 1)
    known = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
    known = known.agg(of_quality.alias("good"), of_toxic.alias("toxic"))
    joined = rows.join(known, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def steps() -> list[dict]:
    """The 600 steps of all orders: the order, the step, and the bits of its filter and of those before."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            found.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return found


def report(counts: DataFrame) -> DataFrame:
    """What each step of each order removes in each part, from the documents of each mask.

    A document that fails k filters is removed by each of them in 120 / k of the 120 orders.
    """
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    plan = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order string, step int, bit int, before int>>")
    rows = cells.select("part", "cells", F.explode(plan).alias("at"))

    def total(condition: str, value: str = "c.n") -> Column:
        return F.expr(f"aggregate(filter(cells, c -> {condition}), 0L, (sum, c) -> sum + {value})")

    fails, passed = "c.mask & at.bit <> 0", "c.mask & at.before = 0"
    return rows.select(
        "part",
        "at.filter_order",
        "at.step",
        total("c.mask & (at.before | at.bit) = 0").alias("kept"),
        total(f"{fails} AND {passed}").alias("removed"),
        total(f"{fails} AND NOT ({passed})").alias("redundant"),
        total("c.mask = at.bit").alias("unique_fails"),
        total(f"{fails} AND {passed}", "c.good").alias("good_lost"),
        total(f"{fails} AND {passed}", "c.toxic").alias("toxic_lost"),
        total(fails, "c.n * (120 div bit_count(c.mask))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The report over ``docs`` (``doc_id``, ``text``, ``source``) and ``labels`` (``doc_id``,
    ``quality``, ``toxic``): a row for each part, order and step."""
    return report(mask_counts(document_masks(docs, trie_bytes), labels))

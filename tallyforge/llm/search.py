"""Ranked lexical search by the Best Position Algorithm over impact-ordered lists.

Documents are dealt into shards of bounded size, and each is indexed as it is read: a row for
every term of the shard with the documents that hold it and how often, and one with the ids and
lengths of all its documents. From the index come the corpus statistics, so a term's weight is
that of the whole corpus. The rows of the terms that are asked for meet the items in the shard
they belong to. There every term's list is put in order of impact, highest first. An item's
lists are read from the top, side by side, and every document met is looked up in the other
lists, where its place counts as seen too. A list's best position is the last one up to which
all are seen; no document that was never met can score above the sum of the impacts at the best
positions. Once that is strictly below the score of the last of the best documents, the rest of
the lists is not read. The best of all shards are merged with a rank per item.

Scores are integers. A term that an item repeats counts as often. Equal scores are ordered by
ascending id, null ids last.

Results for special rows: a null text, or one without terms, is in no list and not counted among
the documents. Rows that repeat an id are documents of their own, and may both be ranked. An item
without terms, or whose terms are in no document, has no rows; items that repeat an id are ranked
each for itself, and a null item id is an id. Very long texts are read in pieces: a task holds
the text and the counts of its distinct terms. Fewer documents than asked for are all given.
Empty tables give an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import stored

BEST = 10
#: The parameters of the score: saturation and length, in thousandths and hundredths.
SATURATION = 8
LENGTH = 75
SCALE = 1_000_000_000

#: A shard is closed once it has read so many bytes of text or documents.
SHARD_BYTES = 1 << 24
SHARD_ROWS = 1 << 14
PIECE_BYTES = 1 << 24
#: Index rows of a batch that is sent on; items that are looked up together.
ROWS_AT_ONCE = 8192
ITEMS_AT_ONCE = 1024
#: Positions of each list that are read in the first round. Every round reads twice as many.
FIRST_READ = 16
#: A shard's name is the task's number, and below that many bits its number in the task.
NAME_BITS = 33
#: The index row of the documents themselves; no term is empty.
DOCUMENTS = ""

# Terms are runs of ASCII letters and digits and of anything beyond ASCII; only A-Z is folded.
FOLDED = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)
GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


# --- terms and the index ------------------------------------------------------------------


def term_counts(text: bytes, size: int = PIECE_BYTES) -> Counter:
    """How often each term occurs in a text in UTF-8."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        cut = GAP.search(text, at + size)
        end = cut.start() if cut else len(text)
        counts.update(text[at:end].translate(FOLDED).split())
        at = end
    return counts


class Shard:
    """The lists of a shard while its documents are read."""

    def __init__(self) -> None:
        self.bytes = 0
        self.ids: list[object] = []
        self.lengths = array("q")
        self.lists: dict[bytes, tuple[array, array]] = {}

    def add(self, doc_id: object, text: bytes) -> None:
        self.bytes += len(text)
        counts = term_counts(text)
        if not counts:
            return
        row = len(self.ids)
        for term, count in counts.items():
            held = self.lists.get(term)
            if held is None:
                held = self.lists[term] = (array("i"), array("i"))
            held[0].append(row)
            held[1].append(count)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())

    def full(self, most_bytes: int, most_rows: int) -> bool:
        return self.bytes >= most_bytes or len(self.ids) >= most_rows

    def rows(self, name: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The index rows: first that of the documents, then the terms."""
        if not self.ids:
            return
        yield index_batch(name, [DOCUMENTS], [array("i")], [array("i")], [self.ids], [self.lengths], id_type)
        terms = list(self.lists)
        for at in range(0, len(terms), ROWS_AT_ONCE):
            some = terms[at : at + ROWS_AT_ONCE]
            lists = [self.lists[t] for t in some]
            nothing = [None] * len(some)
            words = [t.decode() for t in some]
            yield index_batch(name, words, [x[0] for x in lists], [x[1] for x in lists], nothing, nothing, id_type)


def index_batch(name: int, terms, rows, counts, ids, lengths, id_type: pa.DataType) -> pa.RecordBatch:
    def lists(values, kind):
        offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
        flat = np.concatenate([np.frombuffer(v, kind) for v in values]) if offsets[-1] else np.empty(0, kind)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    columns = {
        "shard": pa.array(np.full(len(terms), name, np.int64)),
        "term": pa.array(terms, pa.string()),
        "df": pa.array(list(map(len, rows)), pa.int64()),
        "rows": lists(rows, np.int32),
        "counts": lists(counts, np.int32),
        "ids": pa.array(ids, pa.list_(id_type)),
        "lengths": pa.array([x if x is None else np.frombuffer(x, np.int64) for x in lengths], pa.list_(pa.int64())),
    }
    return pa.record_batch(list(columns.values()), names=list(columns))


def index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The lists of every shard: ``shard``, ``term``, ``df``, ``rows`` (numbers of the documents in
    their shard) and ``counts``; in the row with the empty term ``ids`` and ``lengths`` by number."""
    kind = dict(docs.dtypes)["doc_id"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << NAME_BITS
        shard, id_type = Shard(), None
        for batch in source:
            id_type = batch.schema.field("doc_id").type
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("doc_id"), texts):
                shard.add(doc_id.as_py(), text.as_py())
                if shard.full(shard_bytes, shard_rows):
                    yield from shard.rows(name, id_type)
                    shard, name = Shard(), name + 1
        yield from shard.rows(name, id_type)

    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    schema = f"shard bigint, term string, df bigint, rows array<int>, counts array<int>, ids array<{kind}>, lengths array<bigint>"
    return rows.mapInArrow(batches, schema)


# --- the search in one shard ----------------------------------------------------------------


class ImpactList:
    """A term's documents in a shard by falling impact, with access by document."""

    __slots__ = ("by_row", "places", "rows", "impacts")

    def __init__(self, rows: np.ndarray, impacts: np.ndarray):
        order = np.argsort(-impacts, kind="stable")
        self.by_row = rows  # ascending
        #: The position in the list of each entry of ``by_row``.
        self.places = np.empty(len(rows), np.int32)
        self.places[order] = np.arange(len(rows), dtype=np.int32)
        self.rows = rows[order]
        self.impacts = impacts[order]

    def look_up(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``rows`` are in the list, and at which positions those are."""
        at = np.searchsorted(self.by_row, rows)
        at[at == len(self.by_row)] = 0
        here = self.by_row[at] == rows
        return here, self.places[at[here]]


def best_rows(lists: list[ImpactList], times: list[int], best: int, documents: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and scores of the documents that can be among the ``best``, equal scores included, and
    how many positions were read in order."""
    seen = [np.zeros(len(x.rows) + 1, dtype=bool) for x in lists]  # the last stays unseen
    positions = [0] * len(lists)
    met = np.zeros(documents, dtype=bool)
    rows, scores = np.empty(0, np.int32), np.empty(0, np.int64)
    depth, width, read = 0, FIRST_READ, 0
    while True:
        new = [x.rows[depth : depth + width] for x in lists]
        read += sum(map(len, new))
        depth, width = depth + width, 2 * width
        some = np.unique(np.concatenate(new))
        some = some[~met[some]]
        met[some] = True
        score = np.zeros(len(some), np.int64)
        bound = 0
        for i, x in enumerate(lists):
            here, places = x.look_up(some)
            score[here] += times[i] * x.impacts[places]
            seen[i][places] = True
            # All is seen up to the first position that is not.
            positions[i] += int(np.argmin(seen[i][positions[i] :]))
            if positions[i] < len(x.rows):
                bound += times[i] * int(x.impacts[positions[i] - 1])
        rows, scores = np.concatenate((rows, some)), np.concatenate((scores, score))
        if len(scores) > best:
            last = np.partition(scores, len(scores) - best)[len(scores) - best]
            rows, scores = rows[scores >= last], scores[scores >= last]
        if all(p == len(x.rows) for p, x in zip(positions, lists)):
            break
        if len(scores) >= best and bound < scores.min():
            break
    return rows, scores, read


def search_shard(table: pa.Table, documents: int, tokens: int, best: int) -> tuple[list, list, list]:
    """Item numbers, ids and scores of the best documents of one shard for each item."""
    at = table["term"].to_pylist().index(DOCUMENTS)
    ids = table["ids"][at].values
    lengths = table["lengths"][at].values.to_numpy()
    norms = 100 - LENGTH + (LENGTH * lengths * documents) // tokens
    wanted: dict[int, tuple[list[ImpactList], list[int]]] = {}
    for i in range(table.num_rows):
        if i == at:
            continue
        rows = table["rows"][i].values.to_numpy()
        counts = table["counts"][i].values.to_numpy().astype(np.int64)
        impacts = table["weight"][i].as_py() * ((SCALE * counts) // (1000 * counts + SATURATION * norms[rows]))
        entries = ImpactList(rows, impacts)
        for item in table["items"][i].as_py():
            lists, times = wanted.setdefault(item["item"], ([], []))
            lists.append(entries)
            times.append(item["times"])
    found_items, found_rows, found_scores = [], [], []
    for item, (lists, times) in wanted.items():
        rows, scores, _ = best_rows(lists, times, best, len(lengths))
        rows, scores = rows[scores > 0], scores[scores > 0]
        if len(rows) > best:
            # Among equal scores the smallest ids, null ids last.
            order = sorted(range(len(rows)), key=lambda r: (-scores[r], not (v := ids[rows[r]]).is_valid, v.as_py()))
            rows, scores = rows[order[:best]], scores[order[:best]]
        found_items += [item] * len(rows)
        found_rows += rows.tolist()
        found_scores += scores.tolist()
    return found_items, ids.take(pa.array(found_rows, pa.int32())), found_scores


# --- the search -------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """``item`` (a number of its own for each row), ``item_id``, ``term`` and ``times``."""
    numbered = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    numbered = numbered.withColumn("item", F.monotonically_increasing_id())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    folded = F.translate("text", upper, lower)
    runs = F.regexp_extract_all(folded, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    terms = numbered.select("item", "item_id", F.explode(runs).alias("term"))
    return terms.groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))


def weight(documents: int, df: Column) -> Column:
    """A term's weight from the number of documents and those that hold it."""
    return F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2.0 * df + 1))).cast("bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    shard_bytes: int = SHARD_BYTES,
    shard_rows: int = SHARD_ROWS,
    items_at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``best`` documents of every row of
    ``items`` (``item_id``, ``text``), and the ``item`` number that tells its rows apart."""
    kind = dict(docs.dtypes)["doc_id"]
    lists = stored(index(docs, shard_bytes, shard_rows))
    asked = stored(item_terms(items))
    whole = lists.filter(F.col("term") == DOCUMENTS)
    lengths = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)
    size = whole.agg(F.sum(F.size("ids").cast("bigint")), F.sum(lengths)).first()
    documents, tokens = size[0] or 0, size[1] or 1

    # The items that ask for a term, in blocks, so that no row of the index carries all of them.
    block = F.pmod(F.xxhash64("item"), F.ceil(F.lit(asked.select("item").distinct().count() / items_at_once)))
    blocks = asked.withColumn("block", F.coalesce(block, F.lit(0)).cast("int"))
    by_term = blocks.groupBy("block", "term").agg(F.collect_list(F.struct("item", "times")).alias("items"))
    df = lists.join(by_term.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("_df"))
    terms = stored(
        by_term.join(df, "term").select("block", "term", "items", weight(documents, F.col("_df")).alias("weight"))
    )
    every = terms.select("block").distinct().withColumn("term", F.lit(DOCUMENTS))
    every = every.withColumns({"items": F.lit(None), "weight": F.lit(None)})
    met = lists.drop("df").join(terms.unionByName(every), "term")

    def search(group: pa.Table) -> pa.Table:
        found, ids, scores = search_shard(group, documents, tokens, best)
        return pa.table({"item": pa.array(found, pa.int64()), "doc_id": ids, "score": pa.array(scores, pa.int64())})

    found = met.groupBy("shard", "block").applyInArrow(search, f"item bigint, doc_id {kind}, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    first = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    known = asked.select("item", "item_id").distinct()
    return first.join(known, "item").select("item_id", "rank", "doc_id", "score", "item")

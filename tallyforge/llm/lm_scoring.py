"""Stupid-backoff scores of documents under an n-gram model of the corpus itself.

A token scores count(n-gram) / count(context) if its n-gram occurs at least ``min_count`` times,
else ``BACKOFF`` times the score of the next shorter n-gram, down to its share of all tokens. A
document's score is the sum of the logarithms.

Documents are dealt into batches of bounded size by a hash. In every batch the distinct n-grams
of each order are counted, so that a frequent one leaves it once. These counts go to the
partition that an n-gram's 64-bit hash belongs to and are added up there: that is the count
table. The totals go back to the batches that asked, where they are joined to the n-grams at
their places and summed per document. Between the steps n-grams travel as packed arrays, sorted
and stored as differences, one row for each batch and partition; texts and counts travel
compressed by zstandard.

An n-gram stands for itself by a 64-bit hash. Of D distinct n-grams about D / 2^64 of each share
theirs with another and are counted together: one in 10^7 at 10^12 of them.

Words are the runs between ASCII white space, with A-Z in lower case. N-grams do not reach over
the beginning of a document: its first tokens start at the order their words allow.

Results for special rows: a null text counts as empty. A text without words has no tokens, a sum
of zero and a null mean. Repeated rows are scored, and counted, each, in batches that their place
in the input decides along with id and text, so that copies of one row are dealt out too. A null
id is scored like any other. A very long text makes its batch as much longer; a task holds the
hashes of a batch's n-grams, some 100 bytes a word. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import texts_of

ORDER = 3
BACKOFF = 0.4
MIN_COUNT = 2
BATCH_BYTES = 8_000_000
#: Of zstandard, for texts on their way to their batches.
TEXT_LEVEL = 6
MARK = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Partition number of the rows that carry the number of tokens.
TOTAL = -1


# --- n-grams ------------------------------------------------------------------------------


def word_hashes(text: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in text.lower().split()], dtype=np.uint64)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its first words and of its last one."""
    mixed = (left * MIX) ^ (right + MARK + (left << np.uint64(6)) + (left >> np.uint64(2)))
    mixed ^= mixed >> np.uint64(33)
    mixed *= MIX
    return mixed ^ (mixed >> np.uint64(29))


class Grams(NamedTuple):
    """N-grams of one order: their hashes, and the tokens they end at."""

    hashes: np.ndarray
    tokens: np.ndarray


def batch_grams(texts: list[bytes], order: int) -> tuple[list[Grams], np.ndarray]:
    """The n-grams of every order up to ``order``, and the number of tokens of each document."""
    words = [word_hashes(t) for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    grams = [Grams(flat, np.arange(len(flat)))]
    for k in range(1, order):
        tokens = np.flatnonzero(place >= k)
        hashes = flat[tokens - k]
        for back in range(k - 1, -1, -1):
            hashes = joined(hashes, flat[tokens - back])
        grams.append(Grams(hashes, tokens))
    return grams, counts


# --- packed arrays ------------------------------------------------------------------------


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, bytes of equal weight together: the upper ones are
    mostly zero and cost nothing once the shuffle compresses them."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts are mostly ones, of which an entropy code leaves little."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(planes)


def unpack_counts(data: bytes) -> np.ndarray:
    planes = zstandard.ZstdDecompressor().decompress(data)
    steps = np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(steps).view("<u8").ravel().astype(np.int64)


def partition_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition by the upper bits, so that a sorted array is cut into runs."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def with_packed_text(rows: DataFrame, level: int = TEXT_LEVEL) -> DataFrame:
    """``rows`` with each ``text`` as compressed bytes: the shuffle's own compression has no entropy
    code and leaves prose nearly as long as it is."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level)
        for batch in source:
            at = batch.schema.get_field_index("text")
            packed = [packer.compress(t.as_buffer()) for t in batch.column(at).cast(pa.large_binary())]
            yield batch.set_column(at, "text", pa.array(packed, pa.binary()))

    schema = ", ".join(f"{name} {'binary' if name == 'text' else kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(batches, schema)


def unpacked(texts: pa.ChunkedArray | pa.Array) -> list[bytes]:
    plain = zstandard.ZstdDecompressor()
    return [plain.decompress(t.as_buffer()) for t in texts]


# --- the three steps ----------------------------------------------------------------------


def requests(batches: DataFrame, parts: int, order: int) -> DataFrame:
    """Counts of a batch's distinct n-grams, one row per order and partition."""

    def count(table: pa.Table) -> pa.Table:
        batch = table["batch"][0].as_py()
        grams, counts = batch_grams(unpacked(table["text"]), order)
        rows = [(batch, 0, TOTAL, b"", pack_counts(np.array([counts.sum()])))]
        for k, gram in enumerate(grams):
            distinct, times = np.unique(gram.hashes, return_counts=True)
            cuts = np.searchsorted(partition_of(distinct, parts), np.arange(parts + 1))
            for part in np.flatnonzero(np.diff(cuts)):
                run = slice(cuts[part], cuts[part + 1])
                rows.append((batch, k, int(part), pack_sorted(distinct[run]), pack_counts(times[run])))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
        return pa.table(columns, names=["batch", "grade", "part", "grams", "counts"])

    schema = "batch bigint, grade int, part bigint, grams binary, counts binary"
    return batches.groupBy("batch").applyInArrow(count, schema)


def totals(asked: DataFrame) -> DataFrame:
    """The count table: what all batches counted, added up by partition, and sent back as the
    totals of the n-grams each batch asked for, in the order it asked."""

    def add(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() == TOTAL:
            whole = sum(int(unpack_counts(c)[0]) for c in table["counts"].to_pylist())
            sums = [pack_counts(np.array([whole]))] * table.num_rows
        else:
            grams = [unpack_sorted(g) for g in table["grams"].to_pylist()]
            times = [unpack_counts(c) for c in table["counts"].to_pylist()]
            distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
            summed = np.zeros(len(distinct), dtype=np.int64)
            np.add.at(summed, place, np.concatenate(times))
            ends = np.cumsum([len(g) for g in grams])
            sums = [pack_counts(summed[p]) for p in np.split(place, ends[:-1])]
        columns = [table["batch"], table["grade"], table["part"], pa.array(sums, pa.binary())]
        return pa.table(columns, names=["batch", "grade", "part", "counts"])

    schema = "batch bigint, grade int, part bigint, counts binary"
    return asked.groupBy("part", "grade").applyInArrow(add, schema)


def scores(batches: DataFrame, answers: DataFrame, order: int, min_count: int, kind: str) -> DataFrame:
    """Totals joined to the n-grams at their places, and the sums per document."""

    def score(docs: pa.Table, found: pa.Table) -> pa.Table:
        grams, tokens = batch_grams(unpacked(docs["text"]), order)
        found = found.sort_by([("grade", "ascending"), ("part", "ascending")])
        grade, part = found["grade"].to_numpy(), found["part"].to_numpy()
        packed = found["counts"].to_pylist()
        whole = int(unpack_counts(packed[np.flatnonzero(part == TOTAL)[0]])[0])
        at = []
        for k, gram in enumerate(grams):
            place = np.unique(gram.hashes, return_inverse=True)[1]
            rows = np.flatnonzero((grade == k) & (part != TOTAL))
            summed = [unpack_counts(packed[i]) for i in rows] or [np.zeros(0, np.int64)]
            count = np.zeros(len(grams[0].tokens), dtype=np.int64)
            count[gram.tokens] = np.concatenate(summed)[place]
            at.append(count)
        logs, backed = backoff_logs(at, tokens, whole, order, min_count)
        owner = np.repeat(np.arange(len(tokens)), tokens)
        sums = np.bincount(owner, weights=logs, minlength=len(tokens)).astype(float)
        backs = np.bincount(owner, weights=backed, minlength=len(tokens)).astype(np.int64)
        mean = [s / n if n else None for s, n in zip(sums.tolist(), tokens.tolist())]
        columns = [docs["doc_id"], pa.array(tokens), pa.array(backs), pa.array(sums), pa.array(mean, pa.float64())]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_backoffs", "log_score", "mean_log_score"])

    schema = f"doc_id {kind}, n_tokens bigint, n_backoffs bigint, log_score double, mean_log_score double"
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)


def backoff_logs(
    at: list[np.ndarray], tokens: np.ndarray, whole: int, order: int, min_count: int
) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of each token's score, and how often it backed off; ``at`` has the corpus
    counts of the n-grams that end at each token, zero where too few words come before it."""
    logs = np.log(at[0] / max(whole, 1))
    backed = np.zeros(len(logs), dtype=np.int64)
    place = np.arange(len(logs)) - np.repeat(np.cumsum(tokens) - tokens, tokens)
    for k in range(1, order):
        context = np.concatenate(([1], at[k - 1]))[: len(logs)]  # of the token before
        seen = (place >= k) & (at[k] >= min_count)
        logs = np.where(place >= k, math.log(BACKOFF) + logs, logs)
        backed += place >= k
        logs[seen] = np.log(at[k][seen] / context[seen])
        backed[seen] = 0
    return logs, backed


# --- the operator -------------------------------------------------------------------------


def lm_scores(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_backoffs``, ``log_score`` and ``mean_log_score`` per row."""
    rows = texts_of(docs)
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    parts = max(1, math.ceil(size / batch_bytes))
    kind = dict(rows.dtypes)["doc_id"]
    # The rows are dealt once, both steps read the same shuffle of them.
    batch = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(parts)).cast("bigint")
    batches = with_packed_text(rows.withColumn("batch", batch))
    answers = totals(requests(batches, parts, order))
    return scores(batches, answers, order, min_count, kind)

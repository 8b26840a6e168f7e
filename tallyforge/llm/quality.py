"""Quality scores from two zstandard dictionaries, one of good texts and one of bad ones.

A text is compressed with either dictionary. The difference of the two sizes, divided by the
larger one, says which kind of text it resembles. A rising curve (isotonic regression) turns it
into the probability of the good label, with each label weighted by its share of all labels.

The dictionaries and the curve are fitted on a bounded sample of labelled rows, ``SAMPLE`` of
each label at most, the ones with the smallest hash of their id, so that the sample does not
depend on partitioning or source. Half of it trains the dictionaries and the other half the
curve. Every text is scored whole. The model, two dictionaries and the curve's knots, is
broadcast; its size has nothing to do with that of the data.

Results for special rows: a null text counts as empty, and an empty text gets the score of no
difference. Rows whose id is null are scored and never used for learning. An id
with both labels, or a null label, teaches nothing. Repeated rows are scored each. Without
labels of both kinds every score is the smoothed share of good labels. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import stored, text_key, texts_of

#: Most labelled rows of each label the model is fitted on, and most bytes of text of them.
SAMPLE = 3000
SAMPLE_BYTES = 24_000_000
DICTIONARY_BYTES = 112_640
LEVEL = 3
HOLD_OUT = 5
THRESHOLD = 0.3


class Model(NamedTuple):
    """Dictionaries as bytes, and the knots of the curve from difference to score."""

    good: bytes
    bad: bytes
    at: list[float]
    score: list[float]


def held_out(doc_id: Column, folds: int = HOLD_OUT) -> Column:
    """Rows kept from learning: CRC-32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def learning_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``quality`` of ids with one label only that are not held out."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    one = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
    return one.filter("quality = _most").drop("_most").filter(~held_out(F.col("doc_id")))


def learning_rows(docs: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    """``quality``, ``half`` and ``text`` of at most ``sample`` labelled ids of each label; an id
    may have many texts."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = [known.filter(F.col("quality") == q).orderBy(*order).limit(sample) for q in (0, 1)]
    half = F.xxhash64("doc_id", F.lit(1)) % 2 == 0
    # At most 2 * sample ids are sent to every task.
    rows = texts_of(docs).join(F.broadcast(few[0].unionByName(few[1])), "doc_id")
    place = F.xxhash64("doc_id", "text").alias("place")
    return rows.select(order[0].alias("rank"), place, "quality", half.alias("half"), "text").distinct()


def collect_texts(rows: DataFrame, most_bytes: int, most_rows: int) -> dict[tuple[int, bool], list[bytes]]:
    """Texts by label and half, in order of hash, up to a quarter of ``most_bytes`` for each, of at
    most ``most_rows`` rows of each label.

    A text that would pass the bound is left out whole; none is cut.
    """
    rows = stored(rows)
    sizes = dict.fromkeys([(q, h) for q in (0, 1) for h in (True, False)], 0)
    found: dict[tuple[int, bool], list[bytes]] = {k: [] for k in sizes}
    wanted = []
    sized = rows.select("rank", "place", "quality", "half", F.octet_length("text").alias("size"))
    few = [sized.filter(F.col("quality") == q).orderBy("rank", "place").limit(most_rows) for q in (0, 1)]
    measured = few[0].unionByName(few[1]).drop("rank")
    for place, quality, half, size in sorted(measured.collect()):
        if sizes[quality, half] + size <= most_bytes // 4:
            sizes[quality, half] += size
            wanted.append((place,))
    chosen = F.broadcast(rows.sparkSession.createDataFrame(wanted, "place bigint"))
    for row in rows.join(chosen, "place", "left_semi").orderBy("place", "text").collect():
        found[row["quality"], row["half"]].append(row["text"].encode())
    return found


def dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary; where there is too little text to train one, the text itself."""
    joined = b"\n".join(texts)
    if len(texts) >= 8 and len(joined) > 4 * DICTIONARY_BYTES:
        pieces = [t[i : i + 4096] for t in texts for i in range(0, len(t), 4096)]
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, d=8, k=256, steps=4).as_bytes()
        except zstandard.ZstdError:
            pass
    return joined


def compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    made = []
    for content in (good, bad):
        kind = zstandard.DICT_TYPE_AUTO if content else zstandard.DICT_TYPE_RAWCONTENT
        known = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
        if known:
            known.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


def difference(text: bytes, pair: list[zstandard.ZstdCompressor]) -> float:
    """How much smaller the good dictionary makes a text than the bad one, from -1 to 1."""
    good, bad = (len(c.compress(text)) for c in pair)
    return (bad - good) / max(good, bad)


def rising_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the weighted isotonic regression of ``y`` on ``x``: pools of neighbours that
    would fall are merged until their means rise."""
    pools: list[np.ndarray] = []
    for i in np.argsort(x, kind="stable"):
        pools.append(np.array([x[i], y[i], 1.0]) * weight[i])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            pools[-2:] = [pools[-2] + pools[-1]]
    return [float(p[0] / p[2]) for p in pools], [float(p[1] / p[2]) for p in pools]


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES
) -> Model:
    """The model from the labelled rows that are not held out."""
    known = learning_labels(labels)
    counts = {row["quality"]: row["n"] for row in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    texts = collect_texts(learning_rows(docs, known, sample), most_bytes, sample)
    good, bad = (dictionary(texts[q, True]) for q in (1, 0))
    if not (good and bad and texts[0, False] and texts[1, False]):
        return Model(b"", b"", [0.0], [share])
    pair = compressors(good, bad)
    rest = [texts[q, False] for q in (0, 1)]
    x = np.array([difference(t, pair) for half in rest for t in half])
    y = np.repeat([0.0, 1.0], [len(half) for half in rest])
    weight = np.repeat([counts[q] / len(rest[q]) for q in (0, 1)], [len(half) for half in rest])
    return Model(good, bad, *rising_curve(x, y, weight))


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``text_key`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        pair = compressors(known.good, known.bad)
        for batch in source:
            texts = batch.column("text").cast(pa.large_binary())
            x = np.array([difference(t.as_py(), pair) for t in texts], dtype=np.float64)
            score = np.interp(x, known.at, known.score)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(score)],
                names=["doc_id", "text_key", "score"],
            )

    rows = texts_of(docs).select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, text_key bigint, score double")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, as they are and where they are: the
    rows are not shuffled, and those that repeat others stay or go together."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(fit(docs, labels, **options)))
    text = docs.columns.index("text")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        pair = compressors(known.good, known.bad)
        for batch in source:
            texts = batch.column(text).cast(pa.large_binary())
            x = np.array([difference(t.as_py() or b"", pair) for t in texts], dtype=np.float64)
            yield batch.filter(pa.array(np.interp(x, known.at, known.score) >= threshold))

    # By number meanwhile, as a function cannot be applied to columns of any name.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(batches, numbered.schema).toDF(*docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``text_key`` of every row."""
    scored = with_score(docs, fit(docs, labels, **options))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "text_key",
    )

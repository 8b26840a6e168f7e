"""Near-duplicate vectors by counting collisions of one-dimensional projections.

A vector is projected on many random directions, which come from a fixed seed. They are dealt
into tables: the first projections of a table, rounded to a randomly shifted grid, say which
part of the table a vector belongs to, and within that part vectors are sorted by the table's
last projection. A pair collides in a table if it is in one part of it and one vector is in the
window centred on the other. Collisions are counted over all tables, and pairs with at least
``MIN_COUNT`` of them are verified by their cosine in double precision.

For two unit vectors at distance s a projection differs by a normal variable of deviation s, so
the chance of a collision is known exactly. The number of tables is the smallest for which a pair
right at the threshold reaches the count with the wanted recall; closer pairs exceed it. The
number of projections rounded to the grid grows with the logarithm of the number of vectors, so
that a part holds a few unrelated vectors whatever that number is.

Equal vectors are collapsed first and count with their number. A pair is verified in the first
table it collides in, so counts of links need no list of pairs: a task returns for every vector
how many links it found and the smallest vector it connects to. Parts of a table with many
vectors are compared block by block.

Results for special rows: vectors that are null, empty, zero, or hold a null or a number that is
not finite link with nothing, and so do rows with a null id. Vectors of different lengths do not
link. Rows that repeat an id are vectors of their own. An empty table gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import connected_components, counted, grouped, in_blocks, local_roots, stored

THRESHOLD = 0.95
RECALL = 0.99
MIN_COUNT = 2
#: Grid cells and half windows, as multiples of the distance at the threshold.
CELL, WINDOW = 6.0, 2.5
#: Unrelated vectors wanted in a part of a table, and the cosine that is taken as unrelated.
PART_ROWS, UNRELATED = 4.0, 0.0
BLOCK_ROWS = 2048
SLAB_ROWS = 8192
PAIRS_AT_ONCE = 32_768
SEED = 20_240_611


class Tables(NamedTuple):
    """``count`` tables, each of ``grid`` rounded projections and one that is sorted."""

    count: int
    grid: int
    cell: float
    window: float
    seed: int = SEED


def normal_below(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def same_cell(distance: float, cell: float) -> float:
    """Chance that two points share a randomly shifted cell, their difference being normal."""
    r = cell / distance
    return 1 - 2 * normal_below(-r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def in_window(distance: float, window: float) -> float:
    return 2 * normal_below(window / distance) - 1


def reaches(count: int, tables: int, chance: float) -> float:
    """Chance of at least ``count`` collisions in ``tables`` tables."""
    fewer = sum(math.comb(tables, k) * chance**k * (1 - chance) ** (tables - k) for k in range(count))
    return 1 - fewer


def calibrated(vectors: int, threshold: float, recall: float, min_count: int) -> Tables:
    """Tables that find a pair at the threshold with the wanted recall."""
    near = math.sqrt(2 - 2 * threshold)
    far = math.sqrt(2 - 2 * UNRELATED)
    cell, window = CELL * near, WINDOW * near
    crowd = max(1.0, vectors * in_window(far, window) / PART_ROWS)
    grid = max(1, math.ceil(math.log(crowd) / -math.log(same_cell(far, cell))))
    chance = same_cell(near, cell) ** grid * in_window(near, window)
    count = min_count
    while reaches(min_count, count, chance) < recall:
        count += 1
    return Tables(count, grid, cell, window)


# --- projections --------------------------------------------------------------------------


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


class Projector:
    """The directions of vectors of one length."""

    def __init__(self, tables: Tables, length: int):
        draw = np.random.Generator(np.random.PCG64([tables.seed, length]))
        self.tables = tables
        self.grid = draw.standard_normal((length, tables.count * tables.grid))
        self.sorted = draw.standard_normal((length, tables.count))
        self.shift = draw.uniform(0, tables.cell, tables.count * tables.grid)
        odd = draw.integers(0, 1 << 63, tables.count * tables.grid, dtype=np.uint64)
        self.mix = odd * np.uint64(2) + np.uint64(1)

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part and sorted projection of each unit vector in each table."""
        cells = np.floor((vectors @ self.grid + self.shift) / self.tables.cell).astype(np.int64)
        mixed = (cells.view(np.uint64) * self.mix).reshape(len(vectors), self.tables.count, self.tables.grid)
        return mixed.sum(axis=2, dtype=np.uint64).view(np.int64), vectors @ self.sorted


def table_rows(classes: DataFrame, tables: Tables, kind: str, whole: bool = True) -> DataFrame:
    """One row per class and table: its part, sorted projection, size, and the vector's bytes,
    which are left empty where not the ``whole`` row is needed."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Projector] = {}
        for batch in source:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                lengths = np.array([len(v) for v in piece.column("embedding")])
                for length in np.unique(lengths):
                    rows = piece.filter(pa.array(lengths == length))
                    flat = rows.column("embedding").flatten().to_numpy(zero_copy_only=False)
                    vectors = flat.reshape(-1, length).astype(kind)
                    project = known.setdefault(int(length), Projector(tables, int(length)))
                    part, place = project(unit(vectors))
                    n = len(vectors)
                    packed = pa.array([v.tobytes() if whole else b"" for v in vectors], pa.binary())
                    for t in range(tables.count):
                        yield pa.record_batch(
                            [
                                pa.array(np.full(n, t, dtype=np.int32)),
                                pa.array(np.full(n, length, dtype=np.int32)),
                                pa.array(part[:, t].copy()),
                                pa.array(place[:, t].copy()),
                                rows.column("class"),
                                rows.column("size"),
                                packed,
                            ],
                            names=["tab", "length", "part", "place", "class", "size", "vector"],
                        )

    schema = "tab int, length int, part bigint, place double, class bigint, size bigint, vector binary"
    return classes.mapInArrow(batches, schema)


# --- collisions ---------------------------------------------------------------------------


def windows(run: np.ndarray, other: np.ndarray, place: np.ndarray, width: float):
    """For each row the targets ``low`` to ``high``: later rows of its own run, or rows of the run
    ``other``, whose place is within ``width``. Rows are sorted by run and place."""
    span = 4 * (np.abs(place).max(initial=0) + width) + 1
    line = run * span + place
    own = other == run
    low = np.where(own, np.arange(len(run)) + 1, np.searchsorted(line, other * span + place - width, "left"))
    high = np.searchsorted(line, other * span + place + width, "right")
    return low, np.where(other < 0, low, np.maximum(low, high))


def collisions(
    table: pa.Table, keys: list[str], tables: Tables, kind: str, threshold: float, min_count: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a slab how many links it has here, and the smallest row it connects to."""
    n = table.num_rows
    columns = [table[c].to_numpy() for c in [*keys, "_block"]]
    fresh = [np.concatenate(([True], c[1:] != c[:-1])) for c in columns]
    new_group, new_run = reduce(np.logical_or, fresh[:-1]), reduce(np.logical_or, fresh)
    run, group = np.cumsum(new_run) - 1, np.cumsum(new_group) - 1
    first_run = run[np.flatnonzero(new_group)][group]
    last_run = np.concatenate((run[np.flatnonzero(new_group)[1:] - 1], run[-1:]))[group]
    # Where two blocks are to meet, the first meets the second; else a block meets itself.
    alone = table["_i"].to_numpy() == table["_j"].to_numpy()
    other = np.where(alone, run, np.where((run == first_run) & (run != last_run), last_run, -1))
    place = table["place"].to_numpy()
    low, high = windows(run, other, place, tables.window)

    size, tab = table["size"].to_numpy(), table["tab"].to_numpy()
    links, roots = np.zeros(n, dtype=np.int64), np.arange(n)
    ends = np.cumsum(high - low)
    total = int(ends[-1]) if n else 0
    if not total:
        return links, roots
    length = table["length"].to_numpy()
    raw = table["vector"]
    parts = np.zeros((n, tables.count), dtype=np.int64)
    places = np.zeros((n, tables.count))
    wide: dict[int, np.ndarray] = {}
    index = np.zeros(n, dtype=np.int64)
    for size_of in np.unique(length):
        rows = np.flatnonzero(length == size_of)
        content = b"".join(raw.take(pa.array(rows)).to_pylist())
        vectors = unit(np.frombuffer(content, dtype=kind).reshape(-1, size_of))
        project = Projector(tables, int(size_of))
        parts[rows], places[rows] = project(vectors)
        wide[int(size_of)], index[rows] = vectors, np.arange(len(rows))
    for at in range(0, total, PAIRS_AT_ONCE):
        pair = np.arange(at, min(at + PAIRS_AT_ONCE, total))
        a = np.searchsorted(ends, pair, side="right")
        b = high[a] - (ends[a] - pair)
        hit = (parts[a] == parts[b]) & (np.abs(places[a] - places[b]) <= tables.window)
        good = (hit.sum(axis=1) >= min_count) & (hit.argmax(axis=1) == tab[a])
        a, b = a[good], b[good]
        cosine = np.zeros(len(a))
        for size_of, vectors in wide.items():
            of = length[a] == size_of
            cosine[of] = np.einsum("ij,ij->i", vectors[index[a[of]]], vectors[index[b[of]]])
        linked = cosine >= threshold
        a, b = a[linked], b[linked]
        np.add.at(links, a, size[b])
        np.add.at(links, b, size[a])
        roots = local_roots(roots, a, b)
    return links, roots


def near_links(
    classes: DataFrame, tables: Tables, threshold: float, min_count: int, block_rows: int
) -> DataFrame:
    """``class``, ``to`` and ``links``: links found for a class in one place, and a class it
    connects to there."""
    kind = "<f8" if "double" in dict(classes.dtypes)["embedding"] else "<f4"
    keys = ["tab", "length", "part", "_i", "_j"]
    rows = table_rows(classes, tables, kind)
    group = ["tab", "length", "part"]
    spread = F.xxhash64("class")
    sample = table_rows(classes.filter(counted(spread)), tables, kind, whole=False)
    blocks = in_blocks(rows, group, spread, block_rows, sample)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(source, keys, SLAB_ROWS):
            links, roots = collisions(table, keys, tables, kind, threshold, min_count)
            found = np.flatnonzero(links)
            ids = table["class"].to_numpy()
            yield pa.record_batch(
                [pa.array(ids[found]), pa.array(ids[roots[found]]), pa.array(links[found])],
                names=["class", "to", "links"],
            )

    together = blocks.repartition(*keys).sortWithinPartitions(*keys, "_block", "place", "class")
    return together.mapInArrow(batches, "class bigint, to bigint, links bigint")


# --- the operator -------------------------------------------------------------------------


def usable(embedding: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0)
    return F.coalesce(whole, F.lit(False))


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    min_count: int = MIN_COUNT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    rows = vectors.select("vec_id", "embedding")
    if dict(rows.dtypes)["embedding"] not in ("array<float>", "array<double>"):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = rows.withColumn("_usable", usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    good = rows.filter("_usable")
    # A class of equal vectors has a number of its own, written before it is used, as rows of one
    # id may hold different vectors.
    classes = good.groupBy("embedding").agg(F.min("vec_id").cast("bigint").alias("low"), F.count("*").alias("size"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()))
    tables = calibrated(max(1, classes.count()), threshold, recall, min_count)
    found = stored(near_links(classes, tables, threshold, min_count, block_rows))
    numbers = found.groupBy("class").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("class").alias("a"), F.col("to").alias("b")))
    labels = stored(
        classes.join(numbers, "class", "left")
        .join(parts.withColumnRenamed("node", "class"), "class", "left")
        .select(
            F.col("embedding").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("_component"),
            "low",
        )
    )
    lows = stored(labels.groupBy("_component").agg(F.min("low").alias("component_id")))
    labels = stored(labels.drop("low").join(lows, "_component"))
    linked = good.join(labels, F.col("embedding") == F.col("_vector"))
    linked = linked.select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("_usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

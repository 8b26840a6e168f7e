"""SentencePiece encoding with the n best segmentations, and decoding.

The pieces of a model file and their scores span a lattice over a text; a segmentation is a path
through it and scores the sum of its pieces. A forward Viterbi pass gives the best score of
every prefix. It is also the exact remaining cost of a search that starts at the end of the
text, so a backward A* search takes segmentations off its queue in order of score, and stops
after n.

A text's lattice falls apart wherever no piece spans two neighbouring characters. Texts are cut
there; the distinct segments of a batch of texts go through the forward pass together, one
position at a time for all of them, and so does the first round of the backward search: the best
path, and the best way to leave it. A text's n best paths can differ from its best one only in
the n - 1 segments that lose least by that, and only those are searched further.

White space is written as the mark U+2581, with one mark before the text. Characters without a
piece become the byte pieces of their UTF-8 form, and so does the mark itself where a text holds
it, which makes decoding exact for every text. The model file is a parameter, is read on every
worker, and must be at the same place there.

Results for special rows: a null text counts as empty. An empty text has no pieces, and one
segmentation with score zero. Equal scores are ordered by the longer last piece. Repeated rows
are encoded each, and a null id like any other. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallyforge.llm.common import texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
CHARS_AT_ONCE = 2_000_000
CACHE_SIZE = 100_000
#: What a character without a piece scores below the worst piece.
UNKNOWN_PENALTY = 10.0
MARK = "▁"
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)
ROOT, DEAD = 1, 0
NONE = -1


class Path(NamedTuple):
    score: float
    pieces: tuple[int, ...]


class PieceModel:
    """Pieces, scores and a trie of a model file, as tables for many characters at once."""

    def __init__(self, path: str):
        loaded = sentencepiece.SentencePieceProcessor(model_file=path)
        count = loaded.get_piece_size()
        self.score = np.array([loaded.get_score(i) for i in range(count)])
        self.ids: dict[str, int] = {}
        self.byte = [loaded.unk_id()] * 256
        self.text = [b""] * count
        for i in range(count):
            piece = loaded.id_to_piece(i)
            if loaded.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte[value] = i
                self.text[i] = bytes([value])
            elif not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i)):
                self.ids[piece] = i
                self.text[i] = piece.replace(MARK, " ").encode()
        self.unknown = float(min(self.score[i] for i in self.ids.values())) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        self._tables()
        self.cache: dict[str, list[Path]] = {}

    def _tables(self) -> None:
        """Characters as small numbers: 0 without a piece, then those of longer pieces, then those
        that are pieces on their own only. ``step`` walks the trie of the longer pieces."""
        inner = sorted({c for p in self.ids if len(p) > 1 for c in p})
        single = sorted({p for p in self.ids if len(p) == 1}.difference(inner))
        self.inner = len(inner)
        self.code = np.zeros(0x110000, dtype=np.int32)
        for number, c in enumerate([*inner, *single], 1):
            self.code[ord(c)] = number
        self.code[ord(" ")], self.code[ord(MARK)] = self.code[ord(MARK)], 0
        # The piece and score of a character on its own, by its number; 0 has none.
        self.alone = np.full(1 + len(inner) + len(single), NONE, dtype=np.int64)
        for number, c in enumerate([*inner, *single], 1):
            self.alone[number] = self.ids.get(c, NONE)
        number = {c: i for i, c in enumerate(inner, 1)}
        self.spanned = np.zeros((self.inner + 1, self.inner + 1), dtype=bool)
        nodes: dict[str, int] = {"": ROOT}
        for piece in self.ids:
            if len(piece) > 1:
                for end in range(1, len(piece) + 1):
                    nodes.setdefault(piece[:end], len(nodes) + 1)
                for a, b in zip(piece, piece[1:]):
                    self.spanned[number[a], number[b]] = True
        for c in inner:
            nodes.setdefault(c, len(nodes) + 1)
        self.step = np.zeros((len(nodes) + 1, self.inner + 1), dtype=np.int32)
        self.piece = np.full(len(nodes) + 1, NONE, dtype=np.int64)
        for prefix, node in nodes.items():
            if prefix:
                self.step[nodes[prefix[:-1]], number[prefix[-1]]] = node
                self.piece[node] = self.ids.get(prefix, NONE)

    def bytes_of(self, ch: str) -> tuple[int, ...]:
        return tuple(self.byte[b] for b in ch.encode())

    # --- one segment ----------------------------------------------------------------------

    def edges(self, text: str, end: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """Pieces that end at ``end``, the longest first: start, score, ids. In ``text`` a space
        stands for the mark."""
        marked = text.replace(MARK, "\0").replace(" ", MARK)
        for start in range(max(0, end - self.longest), end):
            piece = self.ids.get(marked[start:end])
            if piece is not None:
                yield start, float(self.score[piece]), (piece,)
            elif start == end - 1:
                yield start, self.unknown, self.bytes_of(text[start])

    def best(self, text: str, n: int) -> list[Path]:
        """The ``n`` best segmentations of a segment, best first: forward pass, backward A*."""
        known = self.cache.get(text)
        if known is not None and len(known) >= n:
            return known[:n]
        incoming = [[], *(list(self.edges(text, end)) for end in range(1, len(text) + 1))]
        forward = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            forward[end] = max(forward[start] + score for start, score, _ in incoming[end])
        # (cost so far and to come, order of entry, place, score of the suffix, suffix as a chain).
        # Of equals the last one entered goes first, which is the longest piece.
        queue: list = [(-forward[-1], 0, len(text), 0.0, None)]
        entered, found = 0, []
        while queue and len(found) < n:
            _, _, end, suffix, chain = heapq.heappop(queue)
            if end == 0:
                ids: list[int] = []
                while chain:
                    ids.extend(chain[0])
                    chain = chain[1]
                found.append(Path(suffix, tuple(ids)))
                continue
            for start, score, ids_here in reversed(incoming[end]):
                entered -= 1
                total = suffix + score
                heapq.heappush(queue, (-(total + forward[start]), entered, start, total, (ids_here, chain)))
        if len(self.cache) >= CACHE_SIZE:
            self.cache.clear()
        self.cache[text] = found
        return found

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of pieces, without the mark put before the text."""
        return b"".join(map(self.text.__getitem__, ids))[1:]


# --- many segments at once ----------------------------------------------------------------


class Segmented(NamedTuple):
    """Distinct segments: best score, what the second best path loses, and the best path's ids
    from ``first`` to ``last`` in ``ids``."""

    score: np.ndarray
    loss: np.ndarray
    first: np.ndarray
    last: np.ndarray
    ids: np.ndarray


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for ``length[0]`` numbers, then the same for the next."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - length), length)


def segment_all(model: PieceModel, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> Segmented:
    """Forward pass and first round of the backward search for all segments; each is ``length``
    codes from ``first``, none of them 0."""
    count = len(first)
    flat = codes[ranges(first, length)]
    begin = np.cumsum(length) - length
    owner = np.repeat(np.arange(count), length)
    place = np.arange(len(flat)) - begin[owner]
    left = length[owner] - place

    # Edges from the node before character p (node p + owner) over a piece of `size` characters.
    sources, sizes, pieces = [], [], []
    alive = np.arange(len(flat))
    state = np.where(flat <= model.inner, model.step[ROOT, np.minimum(flat, model.inner)], DEAD)
    alone = model.alone[flat]
    sources.append(alive)
    sizes.append(np.ones(len(flat), dtype=np.int32))
    pieces.append(alone)
    size = 1
    while size < model.longest:
        keep = np.flatnonzero((state != DEAD) & (left[alive] > size))
        if not len(keep):
            break
        alive = alive[keep]
        state = model.step[state[keep], flat[alive + size]]
        size += 1
        piece = model.piece[state]
        ends = np.flatnonzero(piece >= 0)
        sources.append(alive[ends])
        sizes.append(np.full(len(ends), size, dtype=np.int32))
        pieces.append(piece[ends])
    source, size, piece = np.concatenate(sources), np.concatenate(sizes), np.concatenate(pieces)
    score = np.where(piece >= 0, model.score[piece], model.unknown)
    reach = place[source] + size
    # Longer pieces first, so that of equal scores the longer last piece stays.
    order = np.argsort(reach.astype(np.int64) * 64 + (63 - np.minimum(size, 63)), kind="stable")
    source, size, piece, score, reach = (x[order] for x in (source, size, piece, score, reach))
    at = source + owner[source]
    to = at + size

    best = np.full(len(flat) + count, -np.inf)
    best[begin + np.arange(count)] = 0.0
    via = np.full(len(flat) + count, NONE, dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], (reach[1:] != reach[:-1]) | (size[1:] != size[:-1])))) if len(to) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(to)]):
        # Edges of one length that end at one place of their segments: each has an end of its own.
        total = best[at[lo:hi]] + score[lo:hi]
        better = np.flatnonzero(total > best[to[lo:hi]])
        best[to[lo:hi][better]] = total[better]
        via[to[lo:hi][better]] = lo + better

    # Walk the best paths back, all segments at once.
    suffix = np.full(len(flat) + count, np.nan)
    node = begin + np.arange(count) + length
    suffix[node] = 0.0
    final = best[node]
    running = np.arange(count)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    gone = np.zeros(count)
    while True:
        edge = via[node]
        going = np.flatnonzero(edge >= 0)
        if not len(going):
            break
        running, edge = running[going], edge[going]
        gone = gone[going] + score[edge]
        steps.append((running, edge))
        node = at[edge]
        suffix[node] = gone
    # The best way to leave the best path: any other edge into one of its nodes.
    loss = np.full(count, np.inf)
    leaving = np.flatnonzero(~np.isnan(suffix[to]) & (via[to] != np.arange(len(to))))
    total = best[at[leaving]] + score[leaving] + suffix[to[leaving]]
    np.minimum.at(loss, owner[source[leaving]], final[owner[source[leaving]]] - total)

    taken = np.zeros(count, dtype=np.int64)
    for who, _ in steps:
        taken[who] += 1
    last = np.cumsum(taken)
    ids = np.zeros(int(last[-1]) if count else 0, dtype=np.int64)
    for back, (who, edge) in enumerate(steps):
        ids[last[who] - 1 - back] = piece[edge]
    return Segmented(final, loss, last - taken, last, ids)


class Encoded(NamedTuple):
    """Best ids of a text, and the n best paths as (score, changed segments)."""

    ids: np.ndarray
    scores: list[float]
    paths: list[np.ndarray]


def encode_all(model: PieceModel, texts: list[str], n: int) -> Iterator[Encoded]:
    """The ``n`` best segmentations of every text. Texts are taken together up to a size."""
    at = 0
    while at < len(texts):
        upto, chars = at, 0
        while upto < len(texts) and (upto == at or chars + len(texts[upto]) < CHARS_AT_ONCE):
            chars += len(texts[upto]) + 1
            upto += 1
        yield from encode_some(model, texts[at:upto], n)
        at = upto


def encode_some(model: PieceModel, texts: list[str], n: int) -> Iterator[Encoded]:
    marked = [f" {t}" if t else "" for t in texts]
    joined = "".join(marked)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(points):
        for _ in texts:
            yield Encoded(np.zeros(0, dtype=np.int64), [0.0], [np.zeros(0, dtype=np.int64)])
        return
    codes = model.code[points]
    lengths = np.array([len(t) for t in marked], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths

    cut = np.ones(len(codes), dtype=bool)
    inner = codes * (codes <= model.inner)
    cut[1:] = ~model.spanned[inner[:-1], inner[1:]]
    cut[begins[lengths > 0]] = True
    first = np.flatnonzero(cut)
    length = np.diff(first, append=len(codes))
    distinct, inverse = same_segments(points, first, length)
    known = codes[first[distinct]] > 0  # a character without a piece is a segment of its own
    found = segment_all(model, codes, first[distinct[known]], length[distinct[known]])

    # Spread to all distinct segments; those without a piece take the ids of their bytes.
    total = len(distinct)
    score, loss = np.full(total, model.unknown), np.full(total, np.inf)
    score[known], loss[known] = found.score, found.loss
    start, size = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    start[known], size[known] = found.first, found.last - found.first
    extra = [model.bytes_of(joined[first[distinct[i]]]) for i in np.flatnonzero(~known)]
    size[~known] = [len(x) for x in extra]
    start[~known] = len(found.ids) + np.cumsum([0, *(len(x) for x in extra)][:-1]) if extra else 0
    ids = np.concatenate((found.ids, np.array([i for x in extra for i in x], dtype=np.int64)))

    text_of = np.searchsorted(begins + lengths, first, side="right")
    per_text = np.searchsorted(text_of, np.arange(len(texts) + 1))
    sums = np.bincount(text_of, weights=score[inverse], minlength=len(texts))
    flat = ids[ranges(start[inverse], size[inverse])]
    ends = np.concatenate(([0], np.cumsum(size[inverse])))
    lost = loss[inverse]
    for i in range(len(texts)):
        lo, hi = per_text[i], per_text[i + 1]
        own = flat[ends[lo] : ends[hi]]
        here = lost[lo:hi]
        few = np.argpartition(here, n - 2)[: n - 1] if 1 < n <= len(here) else np.arange(len(here) if n > 1 else 0)
        few = sorted(int(lo + j) for j in few if np.isfinite(here[j]))
        options = [model.best(joined[first[j] : first[j] + length[j]], n) for j in few]
        scores, paths = [], []
        for change, choice in best_sums(options, n):
            scores.append(float(sums[i]) + change)
            paths.append(replaced(own, choice, few, options, ends, ends[lo]))
        yield Encoded(paths[0], scores, paths)


def same_segments(points: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index of each distinct segment, and the distinct segment of each; told apart by a
    64-bit hash, a polynomial in the characters."""
    up = np.cumprod(np.full(len(points) + 1, BASE, dtype=np.uint64))
    down = np.cumprod(np.full(len(points) + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64))
    terms = (points.astype(np.uint64) + np.uint64(1)) * up[:-1]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    hashes = (sums[first + length] - sums[first]) * down[first]
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MIX
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return index, inverse


def best_sums(options: list[list[Path]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best choices of one path per segment, as change of score and indices."""
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for paths in options:
        wider = [(s + p.score - paths[0].score, (*c, k)) for s, c in sums for k, p in enumerate(paths)]
        sums = sorted(wider, key=lambda x: (-x[0], x[1]))[:n]
    return sums


def replaced(own, choice, few, options, ends, offset) -> np.ndarray:
    """The best ids of a text with the chosen paths of some segments put in."""
    parts, done = [], 0
    for k, j, paths in zip(choice, few, options):
        parts += [own[done : ends[j] - offset], np.array(paths[k].pieces, dtype=np.int64)]
        done = ends[j + 1] - offset
    return np.concatenate([*parts, own[done:]]) if parts else own


# --- the operator -------------------------------------------------------------------------


def encode(docs: DataFrame, model_file: str = MODEL, n_best: int = N_BEST, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``n_pieces``, ``ids_sha256`` (little-endian 32-bit ids of the best path),
    ``scores`` of the n best, whether each of them decodes to the text (``round_trip``), and with
    ``with_ids`` the ``ids`` of each of the n best."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded_model(model_file)
        for batch in source:
            for at in range(0, batch.num_rows, 500):
                yield encoded(model, batch.slice(at, 500))

    def encoded(model: PieceModel, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        pieces, digests, scores, exact, ids = [], [], [], [], []
        for text, found in zip(texts, encode_all(model, texts, n_best)):
            raw = text.encode()
            pieces.append(len(found.ids))
            digests.append(hashlib.sha256(found.ids.astype("<i4").tobytes()).hexdigest())
            scores.append(found.scores)
            exact.append(all(model.decode(p.tolist()) == raw for p in found.paths))
            if with_ids:
                ids.append([p.astype(np.int32).tolist() for p in found.paths])
        columns = [batch.column("doc_id"), pa.array(pieces, pa.int64()), pa.array(digests, pa.string())]
        columns += [pa.array(scores, pa.list_(pa.float64())), pa.array(exact, pa.bool_())]
        names = ["doc_id", "n_pieces", "ids_sha256", "scores", "round_trip"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.list_(pa.int32()))))
            names.append("ids")
        return pa.record_batch(columns, names=names)

    rows = texts_of(docs)
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_pieces bigint, ids_sha256 string, scores array<double>, round_trip boolean"
    return rows.mapInArrow(batches, schema + (", ids array<array<int>>" if with_ids else ""))


def decode(encoded: DataFrame, model_file: str = MODEL) -> DataFrame:
    """``doc_id`` and ``text`` of rows ``doc_id``, ``ids`` (one sequence of pieces); null ids give
    a null text, and bytes that are not UTF-8 the replacement character."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded_model(model_file)
        for batch in source:
            texts = [
                None if ids is None else model.decode(ids).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(batches, f"doc_id {kind}, text string")


_models: dict[str, PieceModel] = {}


def loaded_model(path: str) -> PieceModel:
    """The model of this worker; its tables are built once."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]

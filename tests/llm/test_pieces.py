import hashlib
import random

import numpy as np
import pytest
from llm_rows import documents, special_rows

from tallyforge.llm import pieces
from tallyforge.llm.pieces import MODEL, PieceModel, decode, encode, encode_all


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


def all_paths(model, text):
    """Every segmentation of a text, best first."""
    marked = f" {text}" if text else ""
    found = []

    def back(end, score, ids):
        if end == 0:
            found.append((score, ids))
        for start, more, here in model.edges(marked, end) if end else ():
            back(start, score + more, here + ids)

    back(len(marked), 0.0, ())
    return sorted(found, key=lambda p: -p[0])


def short_texts():
    draw = random.Random(0)
    parts = ["a", "the", "in", " ", "  ", "ö", "▁", "\n", "x", "un", "梦", "😀", "e", "s", ".", "\r\n", "\0"]
    return ["".join(draw.choices(parts, k=draw.randrange(6))) for _ in range(300)]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_equals_all_segmentations(model, n):
    texts = short_texts()
    for text, found in zip(texts, encode_all(model, texts, n)):
        paths = all_paths(model, text)
        assert found.scores == [score for score, _ in paths[:n]]
        known = dict((ids, score) for score, ids in paths)
        own = [tuple(p.tolist()) for p in found.paths]
        assert len(set(own)) == len(own) and [known[ids] for ids in own] == found.scores
        assert all(model.decode(ids) == text.encode() for ids in own)
        assert tuple(found.ids.tolist()) == own[0]


def test_batches_do_not_matter(model, monkeypatch):
    texts = short_texts()
    together = [(e.ids.tolist(), e.scores) for e in encode_all(model, texts, 3)]
    monkeypatch.setattr(pieces, "CHARS_AT_ONCE", 10)
    assert [(e.ids.tolist(), e.scores) for e in encode_all(model, texts, 3)] == together


def test_search_equals_forward_pass(model):
    draw = random.Random(1)
    for _ in range(50):
        text = "".join(draw.choices("etaoinshrdlu", k=12))
        best = model.best(text, 3)
        found = pieces.segment_all(model, model.code[[ord(c) for c in text]], np.array([0]), np.array([12]))
        assert best[0].score == found.score[0] and best[0].score - best[1].score == found.loss[0]
        assert found.ids.tolist() == list(best[0].pieces)


def test_long_word_without_cuts(model):
    text = "etaoin" * 5000
    found = next(encode_all(model, [text], 2))
    assert model.decode(found.ids.tolist()) == text.encode() and len(found.scores) == 2


def test_operator_and_special_rows(spark, model):
    rows = special_rows()
    docs = documents(spark, rows, clashing=True)
    found = encode(docs, n_best=3)
    done = found.collect()
    assert len(done) == len(rows) and all(r.round_trip for r in done)
    for r in done:
        assert r.n_pieces == len(r.ids[0])
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids[0], dtype="<i4").tobytes()).hexdigest()
        assert r.scores == sorted(r.scores, reverse=True) and len(r.scores) == len(r.ids)
    assert [(r.n_pieces, r.scores) for r in done if r.doc_id == 5] == [(0, [0.0])]
    back = decode(found.selectExpr("doc_id", "ids[0] AS ids")).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert encode(documents(spark, [])).collect() == []


def test_decode_of_odd_ids(spark, model):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [model.byte[0xFF]])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.text for r in decode(frame).collect()}[1] is None

"""Ranked search: terms, lists and stopping against plain code, the whole against scoring all documents."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_rows import documents, prose, special_rows

from tallyforge.llm import search as s
from tallyforge.llm.oracle import all_oracles


def plain_terms(text):
    found, held = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 0x80 or (c.isascii() and c.isalnum()):
            held += c.lower() if c.isascii() else c
        elif held:
            found.append(held)
            held = ""
    return found


def plain_ranking(docs, items, best=10):
    """(item, item_id, rank, doc_id, score) by scoring every document for every item."""
    known = [(i, plain_terms(t)) for i, t in docs]
    known = [(i, t, Counter(t)) for i, t in known if t]
    n, total = len(known), sum(len(t) for _, t, _ in known)
    df = Counter(term for _, _, c in known for term in c)
    found = []
    for number, (item_id, text) in enumerate(items):
        scored = []
        for doc_id, terms, counts in known:
            norm = 25 + 75 * len(terms) * n // total
            score = 0
            for term in plain_terms(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * (1000000000 * tf // (1000 * tf + 8 * norm))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda r: r[:3])[:best], 1):
            found.append((number, item_id, rank, doc_id, -score))
    return found


def rows_of(found):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect())


def without_number(found):
    return Counter(r[1:] for r in found)


def corpus(seed, n=120):
    draw = random.Random(seed)
    rows = [(i, prose(draw.randrange(40), draw.choice([1, 5, 30, 200]), draw.choice([8, 60]))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, prose(1, 30)), (None, prose(1, 30)), (3, prose(2, 30)), (3, prose(1, 30)), (n + 2, "!? --")]


ITEMS = [(i, prose(i + 50, 12, 60)) for i in range(25)] + [
    (25, "W1X2 w1x2 w1x2, w3x4!"), (25, "w5x5"), (None, "w7x1 w7x2"), (27, None), (28, ""), (29, "no such term Ä"), (30, "w1x1 " * 50),
]


def items_frame(spark, items, clashing=False):
    if clashing:
        return spark.createDataFrame([(*i, 1, "t", 2) for i in items], "item_id bigint, text string, item int, term string, times int")
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("text", ["", "a", "A-B_c9 Ä é.É", "x\x00y\x7fz{|}", "梦 a梦b 😀", "\x80 w", prose(3, 90)])
@pytest.mark.parametrize("size", [1, 3, 1 << 24])
def test_terms(text, size):
    assert s.term_counts(text.encode(), size) == Counter(t.encode() for t in plain_terms(text))


def test_very_long_text():
    text = "Ab cd-" * 3_000_000
    assert s.term_counts(text.encode(), 1 << 20) == {b"ab": 3_000_000, b"cd": 3_000_000}


def random_lists(draw, documents):
    lists = []
    for _ in range(draw.randrange(1, 6)):
        rows = np.array(sorted(draw.sample(range(documents), draw.randrange(1, documents))), np.int32)
        impacts = np.array([draw.choice([0, 1, 5, 5, 9, 40, 1000]) * draw.choice([1, 3]) for _ in rows], np.int64)
        lists.append((rows, impacts, draw.randrange(1, 4)))
    return lists


@pytest.mark.parametrize("seed", range(150))
@pytest.mark.parametrize("first", [1, 16])
def test_stopping_loses_none(monkeypatch, seed, first):
    monkeypatch.setattr(s, "FIRST_READ", first)
    draw = random.Random(seed)
    documents = draw.choice([3, 20, 300])
    lists = random_lists(draw, documents)
    total = Counter()
    for rows, impacts, times in lists:
        for r, i in zip(rows.tolist(), impacts.tolist()):
            total[r] += i * times
    best = draw.choice([1, 3, 10])
    rows, scores, read = s.best_rows([s.ImpactList(r, i) for r, i, _ in lists], [t for *_, t in lists], best, documents)
    assert all(total[r] == score for r, score in zip(rows.tolist(), scores.tolist()))
    least = sorted(total.values(), reverse=True)[:best][-1]
    assert {r: v for r, v in total.items() if v >= least} == dict(zip(rows.tolist(), scores.tolist()))
    assert read <= sum(len(r) for r, *_ in lists)


def test_best_positions_stop_before_last_read_ones():
    """Documents met in one list fill the top of the other, so the best position of that one is
    deeper than what was read in order, and nothing more need be read."""
    documents = 4000
    rows = np.arange(documents, dtype=np.int32)
    a = np.where(rows < 20, 100, 1).astype(np.int64)
    b = np.where((rows < 12) | (rows >= 16) & (rows < 24), 90, 1).astype(np.int64)
    lists = [s.ImpactList(rows, a), s.ImpactList(rows, b)]
    found, scores, read = s.best_rows(lists, [1, 1], 10, documents)
    assert read < 200 and len(found) == 16 and set(scores.tolist()) == {190}


@pytest.mark.parametrize("seed, shard_rows, shard_bytes, at_once", [(1, 1 << 14, 1 << 24, 1024), (2, 7, 1 << 24, 3), (3, 1 << 14, 300, 1)])
def test_equals_scoring_all(spark, seed, shard_rows, shard_bytes, at_once):
    rows = corpus(seed)
    docs = documents(spark, rows, clashing=seed == 2).repartition(3)
    items = items_frame(spark, ITEMS, clashing=seed == 2)
    found = s.ranked(docs, items, shard_bytes=shard_bytes, shard_rows=shard_rows, items_at_once=at_once)
    assert rows_of(found) == without_number(plain_ranking(rows, ITEMS))


def test_fewer_best(spark):
    rows = corpus(4)
    found = s.ranked(documents(spark, rows), items_frame(spark, ITEMS), best=2, shard_rows=30)
    assert rows_of(found) == without_number(plain_ranking(rows, ITEMS, best=2))


def test_equals_sql(spark):
    rows = special_rows() + corpus(5)
    docs, items = documents(spark, rows), items_frame(spark, ITEMS)
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        db.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
        sql = Counter(db.execute(all_oracles()["op11_ranked_search"]).fetchall())
    assert sql == rows_of(s.ranked(docs, items, shard_rows=9)) == without_number(plain_ranking(rows, ITEMS))


def test_empty_tables(spark):
    none, items = documents(spark, []), items_frame(spark, ITEMS)
    assert s.ranked(none, items).collect() == []
    assert s.ranked(documents(spark, [(1, None), (2, "?")]), items).collect() == []
    assert s.ranked(documents(spark, [(1, "a")]), items_frame(spark, [])).collect() == []
    only = s.ranked(documents(spark, [(1, "a b"), (2, "c")]), items_frame(spark, [(9, "A")]))
    assert [(r.item_id, r["rank"], r.doc_id) for r in only.collect()] == [(9, 1, 1)]

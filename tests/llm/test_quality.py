import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
import zstandard
from llm_rows import documents, prose, special_rows

from tallyforge.llm.quality import accepted, collect_texts, fit, learning_rows, quality_scores, rising_curve


def labelled(spark, n=400):
    rows = [(i, prose(i, 50) if i % 3 else " ".join(f"{w}!!&&" for w in prose(i, 50).upper().split())) for i in range(n)]
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(n)], "doc_id bigint, quality int, toxic int")
    return rows, labels


def test_learns_what_is_held_out(spark):
    rows, labels = labelled(spark)
    found = quality_scores(documents(spark, rows), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == bool(r.doc_id % 3) for r in held) / len(held) > 0.95


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows)
    other = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality", "toxic"
    )
    assert fit(docs, labels) == fit(docs, other)


def test_sample_is_bounded_and_stable(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows)
    assert fit(docs, labels, sample=40) == fit(docs.repartition(5), labels.repartition(3), sample=40)


def plain_model(spark, rows, labels):
    """Dictionaries, knots and scores anew: every labelled row that is not held out, no sample."""
    known = {}
    for i, quality, _ in labels:
        known.setdefault(i, set()).add(quality)
    learnt = [(i, t, known[i]) for i, t in rows if i in known and len(known[i]) == 1 and zlib.crc32(str(i).encode()) % 5]
    hashes = {(r.doc_id, r.text): r for r in documents(spark, rows).selectExpr(
        "doc_id", "text", "xxhash64(doc_id, 1) % 2 = 0 AS half", "xxhash64(doc_id, text) AS place").collect()}
    texts = {(q, h): [] for q in (0, 1) for h in (True, False)}
    for i, t, (quality,) in sorted(learnt, key=lambda r: hashes[r[0], r[1]].place):
        texts[quality, hashes[i, t].half].append(t.encode())

    def dictionary(parts):
        if len(b"\n".join(parts)) <= 4 * 112_640:  # too little to train one
            return zstandard.ZstdCompressionDict(b"\n".join(parts), dict_type=zstandard.DICT_TYPE_AUTO)
        pieces = [t[i : i + 4096] for t in parts for i in range(0, len(t), 4096)]
        return zstandard.ZstdCompressionDict(zstandard.train_dictionary(112_640, pieces, d=8, k=256, steps=4).as_bytes())

    good, bad = (dictionary(texts[q, True]) for q in (1, 0))

    def size(text, known):
        made = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(made.compress(text))

    def x(text):
        a, b = size(text, good), size(text, bad)
        return (b - a) / max(a, b)

    points = [(x(t), q, 1 / len(texts[q, False])) for q in (0, 1) for t in texts[q, False]]
    counts = {q: sum(k == {q} and zlib.crc32(str(i).encode()) % 5 != 0 for i, k in known.items()) for q in (0, 1)}
    points = sorted((v, q, w * counts[q]) for v, q, w in points)
    # The isotonic fit by its definition: the largest of the means to the left, each the smallest to the right.
    fitted = []
    for i in range(len(points)):
        best = 0.0
        for a in range(i + 1):
            best = max(best, min(
                sum(w * q for _, q, w in points[a : b + 1]) / sum(w for *_, w in points[a : b + 1]) for b in range(i, len(points))
            ))
        fitted.append(best)
    # Neighbours with one value are a pool; between the centres of pools the curve is a line.
    centres, values = [], []
    for value, group in groupby(zip(points, fitted), key=lambda p: round(p[1], 9)):
        pool = [p for p, _ in group]
        centres.append(sum(v * w for v, _, w in pool) / sum(w for *_, w in pool))
        values.append(value)
    return lambda text: float(np.interp(x(text), centres, values))


@pytest.mark.parametrize("words", [30, 3000])
def test_scores_equal_a_plain_computation(spark, words):
    def junk(i):
        return prose(i, words // 2, 90) + " " + prose(i + 99, words // 2, 90).upper() + " !!&&" * (i % 4)

    rows = [(i, prose(i, words, 90) if i % 3 else junk(i)) for i in range(90)]
    labels = [(i, int(bool(i % 3) ^ (i % 7 == 0)), 0) for i in range(80)] + [(4, 0, 0)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    score = plain_model(spark, rows, labels)
    found = quality_scores(documents(spark, rows), frame).collect()
    assert len(found) == len(rows)
    assert len({r.score for r in found}) > 10
    for r in found:
        assert r.score == pytest.approx(score(dict(rows)[r.doc_id].encode()), abs=1e-7)


def test_accepted_rows_are_those_predicted_good(spark):
    rows, labels = labelled(spark, 120)
    rows = rows + special_rows() + rows[:5] * 3
    docs = documents(spark, rows, clashing=True)
    good = {(r.doc_id, r.text_key) for r in quality_scores(docs, labels).filter("predicted = 1").collect()}
    keyed = docs.selectExpr("*", "xxhash64(coalesce(text, '')) AS text_key")
    wanted = Counter(map(str, [r[:-1] for r in map(tuple, keyed.collect()) if (r[0], r[-1]) in good]))
    kept = accepted(docs, labels)
    assert kept.schema == docs.schema and Counter(str(tuple(r)) for r in kept.collect()) == wanted
    assert 0 < sum(wanted.values()) < len(rows)


def test_accepted_rows_keep_odd_columns(spark):
    _, labels = labelled(spark, 60)
    docs = documents(spark, [(1, prose(1, 50)), (1, prose(1, 50)), (2, None)]).selectExpr("*", "map('k', doc_id) AS more", "1 AS `odd ``name.x`")
    assert [r.more for r in accepted(docs, labels).filter("doc_id = 1").collect()] == [{"k": 1}] * 2
    assert accepted(docs.limit(0), labels).collect() == []


def test_rising_curve():
    x = np.array([0.0, 1.0, 2.0, 3.0])
    at, score = rising_curve(x, np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert at == [0.0, 1.5, 3.0] and score == [0.0, 0.5, 1.0]


def test_special_rows(spark):
    _, labels = labelled(spark)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 0), (5, 0, 0), (7, None, 0)], labels.schema))
    docs = documents(spark, special_rows(), clashing=True)
    assert quality_scores(docs, odd).count() == len(special_rows())
    assert quality_scores(documents(spark, []), labels).collect() == []
    none = quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    good_only = quality_scores(docs, labels.filter("quality = 1")).collect()
    assert len({r.score for r in good_only}) == 1 and good_only[0].score > 0.9


def test_an_id_with_many_texts_gives_few_rows(spark):
    rows = [(1, prose(i, 20)) for i in range(50)] + [(2 + i, prose(100 + i, 20)) for i in range(5)]
    known = spark.createDataFrame([(i, int(i < 4)) for i in range(1, 7)], "doc_id bigint, quality int")
    found = collect_texts(learning_rows(documents(spark, rows), known, 10), 10**6, 10)
    assert sum(len(t) for (quality, _), t in found.items() if quality == 1) == 10
    assert sum(len(t) for (quality, _), t in found.items() if quality == 0) == 3

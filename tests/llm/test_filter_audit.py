"""Filter audit: tries and masks against plain code, the report against filtering in every order."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from llm_rows import documents, prose, special_rows

from tallyforge.llm import filter_audit as fa
from tallyforge.llm.oracle import all_oracles

WHITE = " \t\n\x0b\x0c\r"


def plain_words(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_mask(text):
    words = plain_words(text)
    return (
        (len(words) < 200)
        + 2 * (100 * len(set(words)) < 50 * len(words))
        + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
        + 8 * any(c in "#$%&*|" for c in text)
    )


def plain_masks(rows):
    """(part, id, mask) of every row, by comparing all rows with all."""
    found = []
    for doc_id, text, part in rows:
        smaller = doc_id is not None and any(
            other is not None and other < doc_id and (t or "") == (text or "") for other, t, _ in rows
        )
        found.append((part or "", doc_id, plain_mask(text or "") + 16 * smaller))
    return found


def plain_report(rows, labels):
    """The report by applying the filters one after the other."""
    marked = plain_masks(rows)
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, t in labels if t == 1}
    found = {}
    for part in {p for p, _, _ in marked}:
        mine = [(i, m) for p, i, m in marked if p == part]
        shares = Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                removed = [(i, m) for i, m in left if m & bit]
                before = len(left)
                left = [(i, m) for i, m in left if not m & bit]
                assert before == len(left) + len(removed)
                shares[letter] += len(removed)
                failing = sum(bool(m & bit) for _, m in mine)
                found[part, "".join(order), step] = [
                    len(left),
                    len(removed),
                    failing - len(removed),
                    sum(m == bit for _, m in mine),
                    sum(i in good for i, _ in removed if i is not None),
                    sum(i in toxic for i, _ in removed if i is not None),
                ]
        for (p, order, step), values in found.items():
            if p == part:
                values.append(shares[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def rows_of(report):
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in report.collect()}


def frame(spark, rows, clashing=False):
    schema = "doc_id bigint, text string, source string"
    if clashing:
        schema += ", part string, name int, mask string, low string, head int, size string, prefix int, cells int, `at` int"
        rows = [(*r, "p", 1, "m", "l", 2, "s", 3, 4, 5) for r in rows]
    return spark.createDataFrame(rows, schema)


def many_rows():
    draw = random.Random(7)
    base = prose(1, 260, 5000)
    texts = [None, "", " \t\n", base, base + " x", "A " * 300, "a # b", "Äö 梦 😀", "a\x1fb", "x y", "Ab", "A" + "b" * 49]
    texts += [base[: 100 * i] + "y" for i in range(12)] + [prose(3, 40) * 20]
    rows = [(draw.randrange(60), draw.choice(texts), draw.choice(["s", "s", "s", "t", "", None])) for _ in range(150)]
    rows += [(None, base, "s"), (None, base, None), (None, "lone", "t"), (5, base, "s"), (5, base, "s"), (-1, "", "u")]
    return rows


LABELS = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 40)] + [(4, 0, 1), (5, None, None), (7, 1, 0), (7, 0, 1), (None, 1, 1), (999, 1, 1)]


def test_trie_holds_what_is_put_in():
    draw = random.Random(3)
    texts = {bytes(draw.choice(b"ab") for _ in range(draw.randrange(12))) for _ in range(400)}
    trie = fa.Trie()
    for _ in range(2):
        for t in texts:
            trie.terminal(t).saw(len(t))
    ends = list(trie.terminals())
    assert len(ends) == len(texts) and Counter(e.low for e in ends) == Counter(map(len, texts))
    # Compressed: a place without a terminal has two edges at least.
    waiting = [trie.root]
    while waiting:
        node = waiting.pop()
        assert node is trie.root or node.terminal or len(node.edges) > 1
        waiting += [below for _, below in node.edges.values()]


@pytest.mark.parametrize("seed", range(40))
def test_shared_length(seed):
    draw = random.Random(seed)
    a, b = (bytes(draw.choice(b"aaaaaaaab") for _ in range(draw.randrange(40))) for _ in "ab")
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    assert fa.shared_length(a, b) == same


def test_masks_of_texts():
    for _, text, _ in many_rows():
        assert fa.text_mask((text or "").encode()) == plain_mask(text or "")


def test_very_long_text_in_pieces(monkeypatch):
    text = (prose(1, 400, 90) + "\t") * 3 + "Ä" * 200 + " " + "z" * 300
    whole = fa.text_mask(text.encode())
    for size in (1, 7, 100, 5000):
        cut = list(fa.pieces(text.encode(), size))
        assert b"".join(cut).decode() == text
        assert [w for c in cut for w in c.split()] == text.encode().split()
        monkeypatch.setattr(fa, "PIECE_BYTES", size)
        assert fa.text_mask(text.encode()) == whole == plain_mask(text)
    long = "ab cd " * 2_000_000
    assert fa.text_mask(long.encode()) == 2


@pytest.mark.parametrize("trie_bytes", [1 << 24, 600, 1])
def test_equals_brute_force(spark, monkeypatch, trie_bytes):
    monkeypatch.setattr(fa, "LEAST_SHARE", trie_bytes)
    rows = many_rows()
    docs = frame(spark, rows).repartition(5)
    found = Counter((r.part, r.doc_id, r.mask) for r in fa.document_masks(docs, trie_bytes).collect())
    assert found == Counter(plain_masks(rows))


def test_few_rows_held(spark, monkeypatch):
    monkeypatch.setattr(fa, "ROWS_AT_ONCE", 2)
    rows = many_rows()
    groups = fa.local_groups(frame(spark, rows).coalesce(1), rows_held=7).collect()
    assert len(groups) == len(rows)
    assert sum(g.text is not None for g in groups) == len({g.name for g in groups}) > len({t or "" for _, t, _ in rows})
    assert all((g.text is None) == (g["size"] is None) for g in groups)


def test_prefixes_grow_until_texts_fit(spark):
    texts = [b"x" * n + bytes([65 + n % 7]) * 40 for n in range(300)] + [b"x" * 300] * 5
    rows = spark.createDataFrame([(t, t[: fa.HEAD_BYTES], len(t)) for t in texts], "text binary, head binary, size bigint")
    found = [(bytes(r.prefix), bytes(r.text)) for r in fa.with_prefix(rows, 2000).collect()]
    assert sorted(t for _, t in found) == sorted(texts) and all(t.startswith(p) for p, t in found)
    by_prefix = {}
    for prefix, text in found:
        by_prefix.setdefault(prefix, []).append(text)
    for prefix, members in by_prefix.items():
        assert sum(map(len, members)) <= 2000 or set(members) == {prefix}
    assert {len(p) for p in by_prefix} > {fa.HEAD_BYTES}
    by_text = {}
    for prefix, text in found:
        by_text.setdefault(text, set()).add(prefix)
    assert all(len(p) == 1 for p in by_text.values())


@pytest.mark.parametrize("clashing", [False, True])
def test_report_equals_filtering_in_every_order(spark, clashing):
    rows = many_rows()
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    if clashing:
        labels = labels.selectExpr("*", "1 AS part", "2 AS n", "3 AS mask", "4 AS good")
    found = rows_of(fa.audit(frame(spark, rows, clashing).repartition(3), labels))
    assert found == plain_report(rows, LABELS)


def test_report_equals_sql(spark):
    rows = many_rows() + [(i, t, "s") for i, t in special_rows()]
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    docs = frame(spark, rows)
    with duckdb.connect() as db:
        documents_table, labels_table = docs.toPandas(), labels.toPandas()
        documents_table["doc_id"] = documents_table["doc_id"].astype("Int64")
        db.register("docs_frame", documents_table)
        db.register("labels_frame", labels_table.astype("Int64"))
        db.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text, source FROM docs_frame")
        db.execute("CREATE TABLE labels AS SELECT * FROM labels_frame")
        found = db.execute(all_oracles()["op12_filter_audit"]).fetchall()
    assert {tuple(r[:3]): tuple(r[3:]) for r in found} == rows_of(fa.audit(docs, labels))


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert fa.audit(documents(spark, []), labels).collect() == []
    found = fa.audit(documents(spark, [(1, "a")]), labels).collect()
    assert len(found) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in found)

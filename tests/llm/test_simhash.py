import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_rows import components, documents, prose, special_rows
from pyspark.sql import functions as F

from tallyforge.llm.simhash import (
    close_pairs,
    drop_near_duplicates,
    fingerprint,
    links,
    near_duplicates,
    piece_masks,
    run_windows,
)


def plain_fingerprint(text):
    """The definition, word by word."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lower + " ":
        if c in "\x20\t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [t or "" for _, t in special_rows()] + ["A", "a b c d", "É x y Z"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_hash_is_the_one_of_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b", 42)


def test_any_few_bits_leave_a_table_untouched():
    masks = piece_masks(4, 2)
    draw = random.Random(0)
    for _ in range(2000):
        flips = sum(1 << b for b in draw.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_close_pairs_equals_all_distances():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 63, 5, dtype=np.uint64)
    prints = base[draw.integers(0, 5, 300)]
    for _ in range(6):
        prints = prints ^ (np.uint64(1) << draw.integers(0, 64, 300).astype(np.uint64))
    same = np.sort(draw.integers(0, 4, 300))
    low, high = run_windows(same, np.zeros(300, dtype=np.int32))
    for limit in (0, 1, 3, 4, 7, 8):
        found = {(a, b) for x, y in close_pairs(prints, low, high, limit) for a, b in zip(x.tolist(), y.tolist())}
        distance = np.bitwise_count(prints[:, None] ^ prints[None, :])
        near = (distance <= limit) & (same[:, None] == same[None, :])
        assert found == {(a, b) for a, b in zip(*np.nonzero(np.triu(near, 1)))}


@pytest.mark.parametrize("block_rows", [5, 4096])
def test_links_connect_what_is_close(spark, block_rows):
    draw = random.Random(3)
    prints = set()
    for _ in range(6):
        base = draw.getrandbits(64)
        for _ in range(25):
            moved = base
            for _ in range(draw.randrange(6)):
                moved ^= 1 << draw.randrange(64)
            prints.add(moved - (1 << 64) if moved >> 63 else moved)
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = [(r.a, r.b) for r in links(frame, 4, 2, block_rows).collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 4 for a, b in found) or block_rows
    low = {p: p for p in prints}
    for _ in range(200):
        for a, b in found:
            low[a] = low[b] = min(low[a], low[b])
    assert low == components(prints, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 4)


def test_equals_brute_force(spark):
    rows = special_rows() + [(100 + i, prose(7, 400) + f" {i}") for i in range(12)]
    found = near_duplicates(documents(spark, rows, clashing=True)).collect()
    keys = [(i, plain_fingerprint(t or "")) for i, t in rows]
    prints = {f for _, f in keys}
    low = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    names = {}
    for i, f in keys:
        if i is not None:
            names[low[f]] = min(i, names.get(low[f], i))
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in found) == Counter(
        (i, f, names.get(low[f])) for i, f in keys
    )
    assert len({(r.doc_id, r.text_key) for r in found if r.kept}) == len(set(low.values()))


def test_rows_that_repeat(spark):
    rows = [(1, prose(1, 90))] * 3 + [(2, prose(1, 90)), (None, "a b"), (None, "a b")]
    found = near_duplicates(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        {(1, 1, True): 3, (2, 1, False): 1, (None, None, True): 2}
    )
    assert sorted((r.doc_id or 0) for r in drop_near_duplicates(documents(spark, rows)).collect()) == [0, 1]


def test_very_long_text():
    text = " ".join(f"w{i % 977}" for i in range(400_000))
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    docs = documents(spark, special_rows(), clashing=True)
    kept = drop_near_duplicates(docs).collect()
    ids = [r.doc_id for r in kept]
    assert drop_near_duplicates(docs).schema.names == docs.schema.names
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(12) == 1 and ids.count(11) == 2

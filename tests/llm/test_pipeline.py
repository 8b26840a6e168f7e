from collections import Counter

import corpus_pipeline
import pytest
from llm_rows import components, documents, prose, special_rows
from test_simhash import plain_fingerprint

from tallyforge.llm.common import connected_components
from tallyforge.llm.quality import quality_scores


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = special_rows() + [(1000 + i, prose(i, 60)) for i in range(200)]
    rows += [(2000 + i, " ".join(f"{w}!!&&" for w in prose(i, 60).upper().split())) for i in range(200)]
    documents(spark, rows, clashing=True).write.parquet(f"{path}/documents.parquet")
    labels = [(1000 + i, 1, 0) for i in range(200)] + [(2000 + i, 0, 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, seen, folder)
        assert after.schema.names == docs.schema.names
        assert after.exceptAll(seen).count() == 0
        seen = after.cache()
    texts = [r.text for r in seen.collect()]
    assert len(texts) == len(set(texts))
    bad = [r for r in seen.collect() if r.doc_id and r.doc_id >= 2000]
    assert len(bad) <= 10 and sum(bool(r.doc_id) and 1000 <= r.doc_id < 2000 for r in seen.collect()) >= 190


def test_stages_equal_brute_force(spark, folder):
    """Each stage against plain code over what the one before kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    quality, exact, near = (stage for _, stage in corpus_pipeline.STAGES[:3])

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    kept = quality(spark, docs, folder)
    good = {(r.doc_id, r.text_key) for r in quality_scores(docs, labels).filter("score >= 0.3").collect()}
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS k").collect()
    assert Counter(pairs(kept)) == Counter((r.doc_id, r.text) for r in keyed if (r.doc_id, r.k) in good)

    seen, kept = pairs(kept), exact(spark, kept, folder)
    by_text = {}
    for i, t in seen:
        by_text.setdefault(t or "", []).append(i)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in by_text.items()}
    assert Counter((i, t or "") for i, t in pairs(kept)) == Counter((i, t) for t, i in largest.items())
    assert len(largest) < len(seen)

    seen, kept = pairs(kept), near(spark, kept, folder)
    prints = [plain_fingerprint(t or "") for _, t in seen]
    low = components(range(len(seen)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    names = {}
    for n, (i, _) in enumerate(seen):
        names.setdefault(low[n], []).append(i)
    first = [min((i for i in ids if i is not None), default=None) for ids in names.values()]
    assert Counter(i for i, _ in pairs(kept)) == Counter(first) and len(first) < len(seen)


def test_run_packs_what_the_stages_keep(spark, folder):
    packed = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    size = docs.selectExpr("sum(octet_length(coalesce(text, '')) + 1)").first()[0]
    assert packed.agg({"length": "sum"}).first()[0] == size


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    more = edges + [(b, a) for a, b in edges[::3]] + [(200, 201), (201, 202)] * bool(edges)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(more, "a bigint, b bigint")).collect()}
    linked = {n for a, b in more if a != b for n in (a, b)}
    assert found == {n: 200 if n >= 200 else 0 for n in linked}

import sys

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from collections import defaultdict  # noqa: E402

import corpus_pipeline  # noqa: E402
from conftest import SF_ORACLE  # noqa: E402
from llm_helpers import base_spans, near_components  # noqa: E402


def test_stages_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").limit(0).unionAll(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "minhash_neardup", "pii", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_classifier"](spark, docs, SF_ORACLE).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    single = stage["minhash_neardup"](spark, good, SF_ORACLE).cache()
    want = near_components([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, c in want.items() if i == c)
    assert single.columns == docs.columns
    clean = stage["pii"](spark, single, SF_ORACLE).cache()
    assert clean.schema == docs.schema and clean.count() == single.count()
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        assert r["n_chars"] == len(r["text"])
        assert base_spans(r["text"]) == []
        assert (r["text"] == before[r["doc_id"]]) or "[" in r["text"]
    packed = stage["packing"](spark, clean, SF_ORACLE).collect()
    totals = defaultdict(int)
    for r in packed:
        totals[r["doc_id"]] += r["length"]
    assert set(totals) == {r["doc_id"] for r in clean.collect()}
    assert all(totals[r["doc_id"]] == r["doc_tokens"] for r in packed)

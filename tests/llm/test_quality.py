import zlib

import numpy as np
from conftest import SF_ORACLE

from strata.llm import quality
from strata.llm.queries import op4_quality_classifier


def test_held_out_accuracy_and_columns(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    rows = op4_quality_classifier(spark, SF_ORACLE).collect()
    assert len(rows) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([s >= 0.3 for s in good]) > 0.95
    assert np.mean([[g > b for b in bad] for g in good]) > 0.8


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (None, "some words", 5), (4, "ab " * 100000, 5)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, none).collect()
    assert sorted(r["score"] for r in got) == [0.0, 0.0, 0.0, 0.5, 0.5]
    labels = spark.createDataFrame([(4, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert len(quality.classify(docs, labels).collect()) == 5
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_labels_of_held_out_rows_are_never_learnt(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(tuple(r) for r in quality.classify(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_accepted_documents_keep_their_own_columns(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").selectExpr("*", "-1 as score", "'x' as predicted")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    got = quality.accepted(docs, labels)
    assert got.schema == docs.schema
    rows = got.collect()
    assert all(r["score"] == -1 and r["predicted"] == "x" for r in rows)
    want = [r["doc_id"] for r in quality.classify(docs.select("doc_id", "text"), labels).where("predicted = 1").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(want)

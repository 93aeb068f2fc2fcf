"""Hot keys: one key holds a third of all rows. Results must equal brute force."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import dedupe, facts, keys

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """k = 0 for a third of the rows; the rest spread over 2,000 keys; ties on ts are common."""
    df = spark.range(N, numPartitions=12).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        (F.col("id") * 7 % 97).alias("ts"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("v"),
        (F.col("id") % 7 + 1).alias("line"))
    return df, df.toPandas()


def test_latest_per_key_hot_key(skewed):
    df, pdf = skewed
    got = {r["k"]: r["id"] for r in dedupe.first_per_key(df, "k", [F.col("ts").desc(), "id"]).collect()}
    want = pdf.sort_values(["k", "ts", "id"], ascending=[True, False, True]).drop_duplicates("k")
    assert got == dict(zip(want["k"], want["id"]))


def test_top_n_hot_key(skewed):
    df, pdf = skewed
    got = sorted((r["k"], r["id"]) for r in dedupe.top_n_per_key(df, "k", ["ts", "id"], 3).collect())
    want = pdf.sort_values(["k", "ts", "id"]).groupby("k").head(3)
    assert got == sorted(zip(want["k"], want["id"]))


def test_first_non_null_hot_key(skewed):
    df, pdf = skewed
    got = {r["k"]: r["v"] for r in dedupe.first_non_null(df, "k", ["v"], ["ts", "id"]).collect()}
    nn = pdf[pdf["v"].notna()].sort_values(["k", "ts", "id"]).drop_duplicates("k")
    want = {k: None for k in pdf["k"].unique()}
    want.update(dict(zip(nn["k"], nn["v"])))
    assert got == want


def test_collect_nested_hot_parent(skewed):
    df, pdf = skewed
    got = {r["k"]: r["m"] for r in facts.collect_nested(df, ["k"], "line", F.col("id"), ["ts", "id"], "m").collect()}
    last = pdf.sort_values(["k", "line", "ts", "id"]).groupby(["k", "line"]).tail(1)
    want: dict = {}
    for k, line, i in zip(last["k"], last["line"], last["id"]):
        want.setdefault(k, {})[str(line)] = i
    assert got == want and len(got[0]) == 7


def test_number_rows_matches_rank(skewed, spark):
    df, pdf = skewed
    got = {r["id"]: r["n"] for r in keys.number_rows(df.select("id", "ts"), ["ts", "id"], "n", 100,
                                                     num_partitions=9).collect()}
    ranked = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    assert got == {i: 101 + pos for pos, i in enumerate(ranked["id"])}
    assert pd.Series(list(got.values())).is_unique

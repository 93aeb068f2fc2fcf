"""Plan-shape checks that matter at scale (not just at test size)."""

import os
import re

import pytest

from strata.plans import catalog as C
from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    p = plan(C.q_latest_per_key(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_first_non_null_is_partial_aggregate(spark):
    p = plan(C.q_first_non_null(spark, SF_SMALL))
    assert re.search(r"(Sort|Hash|ObjectHash)Aggregate.*partial_min_by", p, re.S) or p.count("Aggregate") >= 2


def test_scans_prune_columns_and_push_filters(spark):
    p = plan(C.q_hash_keys(spark, SF_SMALL))
    m = re.search(r"ReadSchema: struct<([^>]*)>", p)
    assert m and set(x.split(":")[0] for x in m.group(1).split(",")) == {"page_id", "url"}
    p = plan(C.q_ordered_union_limit(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "TakeOrderedAndProject" in p


def test_label_pivot_has_no_shuffle(spark):
    p = plan(C.q_label_value_pivot(spark, SF_SMALL))
    assert "HashAggregate" not in p and "SortAggregate" not in p


def test_no_unbounded_collect_in_library():
    """Driver round-trips in library code are limited to bounded results."""
    allowed = {
        ("operators/keys.py", "first()"),       # max(id): one scalar
        ("operators/quality.py", "collect()"),  # violations by table and rule
        ("operators/loads.py", "collect()"),    # id ranges of a load's scope
        ("sources/ledger.py", "first()"),       # latest run: one row; newest silver load: one scalar
        ("sources/tables.py", "first()"),       # last commit: one scalar
        ("sources/tables.py", "collect()"),     # parts of a table's current version
        ("streaming/incremental.py", "collect()"),  # new runs of a micro-batch
    }
    found = set()
    for dirpath, dirs, files in os.walk(os.path.join(ROOT, "strata")):
        dirs[:] = [d for d in dirs if d != "llm"]
        for f in files:
            if not f.endswith(".py"):
                continue
            rel = os.path.relpath(os.path.join(dirpath, f), os.path.join(ROOT, "strata"))
            src = open(os.path.join(dirpath, f), encoding="utf-8").read()
            for call in re.findall(r"\.(collect\(\)|toPandas\(\)|first\(\)|take\(\d+\)|count\(\))", src):
                found.add((rel, call))
    assert "toPandas()" not in {c for _, c in found}
    assert found <= allowed, found - allowed


@pytest.mark.parametrize("name", ["clean_text", "prefix_strip", "composite_key", "natural_sort", "parse_date_multi",
                                  "output_contract", "label_value_pivot", "page_table_extract", "fight_page_extract",
                                  "profile_page_extract"])
def test_narrow_queries_shuffle_nothing_and_run_no_python(spark, name):
    p = plan(C.QUERIES[name](spark, SF_SMALL))
    assert "Exchange" not in p and "Python" not in p and "Pandas" not in p


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) * int(c["spark.sql.files.maxPartitionBytes"]) >= 100 * 1024 ** 4
    assert int(scale_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"]) == 24


def test_latest_pages_are_partitioned_by_their_key_once(spark):
    from strata.plans.bronze import latest_pages

    rows = [("e", "a", "d1", "x"), ("e", "a", "d2", "y"), ("e", "a", "d2", "y"), ("e", "b", "d1", "q"),
            ("e", None, "d1", "q"), ("e", "c", "d1", None), ("f", "a", "d9", "z")]
    df = spark.createDataFrame(rows, "kind string, page_key string, dt string, html string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = latest_pages(df, "e")
        p = plan(got)
        assert sorted(map(tuple, got.collect())) == [("a", "y"), ("b", "q"), ("c", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # keys with their latest landing, and the pages: nothing more is moved
    assert p.count("Exchange hashpartitioning") == 2


def test_pages_are_never_broadcast(spark):
    # markup is made of a small file's rows, or read from files that compress it many times: by its estimate it would fit
    from strata.plans import job_queries as J
    for df in (J._fighter_pages(spark, SF_SMALL), J.q_fight_documents(spark, SF_SMALL)):
        p = plan(df)
        assert "SortMergeJoin" in p and "BroadcastExchange" not in p

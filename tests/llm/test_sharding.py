from collections import defaultdict

import duckdb
from conftest import SF_ORACLE

from strata.llm import sharding
from strata.llm.queries import op9_extendible_sharding


def test_query_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_ORACLE}/documents.parquet'")
    got = sorted(tuple(r) for r in op9_extendible_sharding(spark, SF_ORACLE).collect())
    assert got == sorted(con.execute(sharding.ORACLE).fetchall())


def test_small_limits_as_sql(spark, tmp_path):
    rows = [(7, "x" * 100)] * 50 + [(None, None), (None, ""), (1, ""), (2, "y" * 5000)] + [(2, "y" * 5000)] * 2
    rows += [(i, "é" * (i % 90)) for i in range(100, 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    for limit in (1000, 1 << 20):
        got = sorted((tuple(r) for r in sharding.shard(df, limit).select(
            "doc_id", "bytes", "depth", "prefix", "part", "shard_bytes").collect()), key=repr)
        assert len(got) == len(rows)
        assert got == sorted(con.execute(sharding.oracle(limit)).fetchall(), key=repr)


def test_every_shard_fits_and_only_oversized_ones_split(spark):
    rows = [(7, "x" * 100)] * 50 + [(None, None), (None, ""), (1, ""), (2, "y" * 5000)] + [(i, "z" * (i % 90)) for i in range(100, 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as cell", "2 as h", "3 as task")
    got = sharding.shard(df, 1000).collect()
    sums, prefixes, counts = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sums[r["prefix"], r["part"]] += r["bytes"]
        counts[r["prefix"], r["part"]] += 1
        for d in range(len(r["prefix"]) + 1):
            prefixes[r["prefix"][:d]] += r["bytes"]
    assert len(got) == len(rows)
    assert all(r["shard_bytes"] == sums[r["prefix"], r["part"]] and r["depth"] == len(r["prefix"]) for r in got)
    for (prefix, part), n in sums.items():
        assert n <= 1000 or counts[prefix, part] == 1
        assert not prefix or prefixes[prefix[:-1]] > 1000
    assert sharding.shard(df.limit(0)).collect() == []


def test_shards_are_written_with_all_columns_of_every_row(spark, tmp_path):
    rows = [(7, "x" * 100, k) for k in range(50)] + [(None, None, 1), (None, "", 2), (2, "y" * 5000, 3)]
    rows += [(i, "é" * (i % 90), i) for i in range(100, 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h long").selectExpr("*", "cast(h as string) as row")
    sharding.write(df, f"{tmp_path}/s", 1000)
    held = 0
    for folder in sorted(p for p in (tmp_path / "s").iterdir() if p.is_dir()):
        files = list(folder.glob("*.parquet"))
        texts = [r["text"] or "" for r in spark.read.parquet(str(files[0])).select("text").collect()] if held < 20 else []
        held += 1
        assert len(files) == 1 and (sum(len(t.encode()) for t in texts) <= 1000 or len(texts) == 1)
    got = sharding.read(spark, f"{tmp_path}/s", df.schema)
    assert got.columns == ["doc_id", "text", "h", "row", *sharding.RESULT]
    back = got.collect()
    assert sorted((tuple(r)[:4] for r in back), key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)
    assert len({(r["prefix"], r["part"]) for r in back}) == held > 40
    whole = sharding.shard(df, 1000).drop("part").collect()
    assert sorted(tuple(r) for r in got.where("doc_id <> 7").drop("part").collect()) == sorted(
        tuple(r) for r in whole if r["doc_id"] not in (7, None))
    sharding.write(df.limit(0), f"{tmp_path}/none", 1000)
    assert sharding.read(spark, f"{tmp_path}/none", df.schema).collect() == []

"""availableNow stream over dated partitions: each partition exactly once per checkpoint."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strata.plans.catalog import EVENT_SCHEMA
from strata.sources import partitions
from strata.streaming.incremental import run_available, stream_partitions
from conftest import SF_SMALL


def test_new_partitions_once(spark):
    root = tempfile.mkdtemp(prefix="strata-stream-")
    base, ckpt, sink = (os.path.join(root, x) for x in ("bronze", "ckpt", "sink"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    partitions.write_partitions(ev.where(F.col("dt") < "2024-01-10"), base)

    def handle(batch, epoch):
        batch.groupBy("dt_particao").agg(F.count(F.lit(1)).alias("rows")).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(sink)

    run_available(stream_partitions(spark, base, EVENT_SCHEMA), ckpt, handle)
    first = spark.read.parquet(sink).agg(F.sum("rows")).first()[0]
    assert first == ev.where(F.col("dt") < "2024-01-10").count()

    partitions.write_partitions(ev.where(F.col("dt") >= "2024-01-10"), base)
    run_available(stream_partitions(spark, base, EVENT_SCHEMA), ckpt, handle)
    seen = spark.read.parquet(sink)
    assert seen.agg(F.sum("rows")).first()[0] == ev.count()
    assert seen.groupBy("dt_particao").count().where("count > 1").count() == 0


def test_stream_drives_silver_merge_and_refuses_late_days(spark):
    import datetime as dt

    from strata.plans import bronze
    from strata.sources import tables
    from strata.streaming.incremental import silver_on_new_runs
    from test_job import landed

    root = tempfile.mkdtemp(prefix="strata-stream-silver-")
    runs, ckpt = os.path.join(root, "runs"), os.path.join(root, "ckpt")
    pages = landed(spark)
    store = tables.PartitionedTables(spark, os.path.join(root, "silver"))
    now = dt.datetime(2024, 6, 2, 12)
    # partitions without a ledger row are not complete: nothing is loaded
    bronze.run_bronze(spark, pages, root, dt="2024-06-02", ingested_at="2024-06-02T10:00:00Z", full_load=True, anchor="2024-06-02")
    bronze.run_job(spark, pages, root, runs, full_load=True, dt="2024-06-02")
    silver_on_new_runs(spark, root, store, runs, ckpt, now=now)
    assert store.read("historico_lutas").count() == 10 and store.read("eventos").count() == 4
    first = sorted(store.read("eventos").inputFiles())
    silver_on_new_runs(spark, root, store, runs, ckpt, now=now)  # nothing new
    assert sorted(store.read("eventos").inputFiles()) == first
    # a late day would take the newer events of its scope for stale
    late = pages.withColumn("dt", F.when(F.col("dt") == "2024-06-02", "2024-05-20").otherwise(F.col("dt"))).where("kind <> 'events_upcoming'")
    bronze.run_job(spark, late, root, runs, full_load=False, dt="2024-05-20")
    silver_on_new_runs(spark, root, store, runs, ckpt, now=now)
    assert sorted(store.read("eventos").inputFiles()) == first
    assert spark.read.parquet(runs).where("status = 'recusado' AND dt = '2024-05-20'").count() == 1


@pytest.mark.parametrize("dies_at", ["staged", "placed"])
def test_merge_stream_restarts_without_loss_or_doubles(spark, monkeypatch, dies_at):
    """A batch that died after its staging, or after it was put in place, is repeated."""
    from strata.sources import tables
    from strata.streaming.incremental import merge_stream

    root = tempfile.mkdtemp(prefix="strata-stream-merge-")
    base, ckpt, table = (os.path.join(root, x) for x in ("in", "ckpt", "table"))
    schema = "k long, v string, n long"
    from pyspark.sql.types import StructType
    kind = StructType.fromDDL(schema)
    run = lambda: merge_stream(spark, stream_partitions(spark, base, kind, files_per_batch=1), table, ckpt, key="k", order=["n"])
    land = lambda rows: partitions.write_partitions(spark.createDataFrame(rows, schema + ", dt string").coalesce(1), base)
    land([(1, "a", 1, "2024-01-01"), (2, "b", 1, "2024-01-01"), (1, "other day", 1, "2024-01-02"), (5, "late", 3, "2024-01-02")])
    run()
    land([(1, "A", 2, "2024-01-01"), (3, "c", 1, "2024-01-01"), (5, "old", 1, "2024-01-02")])

    remove, read = tables.remove, spark.read
    lost = []

    def dying(session, path):
        if not lost:
            lost.append(path)
            raise RuntimeError("lost")
        remove(session, path)

    if dies_at == "placed":
        monkeypatch.setattr(tables, "remove", dying)
    else:
        from strata.streaming import incremental
        first = incremental.dedupe.first_per_key

        def dying_first(*args):
            if not lost:
                lost.append("x")
                raise RuntimeError("lost")
            return first(*args)
        monkeypatch.setattr(incremental.dedupe, "first_per_key", dying_first)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    run()
    got = sorted((r["dt_particao"], r["k"], r["v"]) for r in read.schema(schema + ", dt_particao string").parquet(table).collect())
    assert got == [("2024-01-01", 1, "A"), ("2024-01-01", 2, "b"), ("2024-01-01", 3, "c"),
                   ("2024-01-02", 1, "other day"), ("2024-01-02", 5, "late")]

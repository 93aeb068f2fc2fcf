"""Streaming entry point for incremental loads.

The stream follows the run ledger: a row says that a bronze run is complete,
with all its partitions landed. ``trigger(availableNow=True)`` picks up every
row once per checkpoint and ``foreachBatch`` loads its ``dt`` by the normal
silver job. A ``dt`` older than the newest loaded one is refused, as in the
batch job: merging it would delete newer events as stale. The refusal is a
ledger row, and the stream goes on. "Late data" within a load is handled the
way the batch job handles it: the newest ``ingested_at`` wins per key.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators import dedupe, loads
from strata.sources import ledger, tables
from strata.sources.partitions import TS_OPTIONS


def stream_partitions(spark: SparkSession, base: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Streaming read of a dated JSONL base; ``dt`` comes from the path as text."""
    full = StructType([*schema.fields, StructField("dt", StringType(), True)])
    reader = spark.readStream.schema(full).options(**TS_OPTIONS).option("basePath", base)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(base).withColumnRenamed("dt", "dt_particao")


def run_available(stream: DataFrame, checkpoint: str, handle_batch: Callable[[DataFrame, int], None]) -> None:
    """Process everything not yet seen by ``checkpoint``, then stop."""
    q = (stream.writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(handle_batch)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def merge_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, *, key: str,
                 order: Sequence[str], day: str = "dt_particao") -> None:
    """Merge everything new in a stream into a table partitioned by ``day``: per key and day the row that is last by ``order``.

    Each micro-batch writes again only the days that it has rows of. What it makes of them is
    staged under the batch's number first. Spark repeats a batch that did not end under the same
    number: if its staging is complete, it is put in place as it is, else it is computed again from
    the untouched table. So a restart neither loses nor doubles rows, wherever the batch died.
    """
    schema = stream.schema

    def handle(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        staging = f"{table}_staging/batch={epoch}"
        if not tables.path_exists(session, os.path.join(staging, "_SUCCESS")):
            new = batch
            if tables.path_exists(session, table):
                days = loads.materialize(batch.select(day).where(F.col(day) > "").distinct(), "stream-days")
                stored = session.read.schema(schema).parquet(table)
                new = stored.join(F.broadcast(days), day, "left_semi").select(*schema.fieldNames()).unionByName(batch)
            latest = dedupe.first_per_key(new.withColumn("_key", F.struct(key, day)), "_key",
                                          [*[F.col(c).desc() for c in order], dedupe.content_hash(new)]).drop("_key")
            latest.write.mode("overwrite").parquet(staging)
        (session.read.schema(schema).parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day).parquet(table))
        tables.remove(session, staging)

    run_available(stream, checkpoint, handle)


def silver_on_new_runs(spark: SparkSession, bronze_root: str, store, ledger_path: str, checkpoint: str, *,
                       now, anchor: str | None = None) -> None:
    """Silver load for every completed bronze run not yet processed, in order of ``dt``.

    A micro-batch's list of days is one row per bronze run, so it is small by construction.
    ``anchor``: the day that scopes count back from (default: the run's own).
    """
    from strata.plans.silver import load

    def handle(batch: DataFrame, epoch: int) -> None:
        done = batch.where((F.col("estagio") == "bronze") & (F.col("status") == ledger.DONE))
        for row in done.groupBy("dt").agg(F.max("tipo_carga").alias("kind")).orderBy("dt").collect():
            run_id = ledger.new_batch()["run_id"]
            try:
                ledger.refuse_older(spark.read.parquet(ledger_path), row["dt"])
            except ValueError:
                ledger.record_run(spark, ledger_path, run_id, row["dt"], row["kind"], "silver", now, ledger.REFUSED)
                continue
            load(spark, bronze_root, store, ledger_path, dt=row["dt"], anchor=anchor or row["dt"], now=now, run_id=run_id)

    run_available(spark.readStream.schema(ledger.LEDGER_SCHEMA).parquet(ledger_path), checkpoint, handle)

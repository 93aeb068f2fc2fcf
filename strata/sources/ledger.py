"""Run ledger: one appended row per completed stage; latest completed run lookup."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = ("run_id string, dt string, tipo_carga string, estagio string, status string, "
                 "iniciado_em timestamp, concluido_em timestamp")
AUDIT_SCHEMA = "run_id string, dt string, stage string, n_rows bigint, created_at timestamp"
REFUSED = "recusado"
PREPARED = "preparado"
DONE = "concluido"


def record_run(spark: SparkSession, path: str, run_id: str, dt: str, load_type: str,
               stage: str, started_at, status: str = DONE) -> None:
    """Append a run row, by default a completed one (finish time taken at write)."""
    (spark.createDataFrame([(run_id, dt, load_type, stage, status, started_at, None)], LEDGER_SCHEMA)
     .withColumn("concluido_em", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(path))


def record_audit(spark: SparkSession, path: str, run_id: str, dt: str, counts: dict) -> None:
    """Append one row per stage with the rows that its write counted."""
    (spark.createDataFrame([(run_id, dt, stage, n, None) for stage, n in counts.items()], AUDIT_SCHEMA)
     .withColumn("created_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(path))


def latest_completed(runs: DataFrame, dt: str | None = None, status_col: str = "status",
                     time_col: str = "iniciado_em", done: str = DONE) -> DataFrame:
    """The newest completed run (optionally for one ``dt``) as a one-row frame.

    Runs started at one time: the one that ended last, then the larger run id.
    """
    q = runs.where(F.col(status_col) == done)
    if dt is not None:
        q = q.where(F.col("dt") == dt)
    ties = [F.col(c).desc() for c in ("concluido_em", "run_id") if c in runs.columns and c != time_col]
    return q.orderBy(F.col(time_col).desc(), *ties).limit(1)


def load_type_for(runs: DataFrame, dt: str | None = None) -> str:
    """Load type of the newest completed run; error when there is none."""
    row = latest_completed(runs, dt).select("tipo_carga").first()
    if row is None:
        raise RuntimeError(f"no completed pipeline run for dt={dt!r}; run the bronze job first")
    return row["tipo_carga"]


def prepared_only(runs: DataFrame, stage: str = "silver") -> DataFrame:
    """Runs of a stage that were prepared but not completed: (run_id, dt, tipo_carga, iniciado_em)."""
    mine = runs.where(F.col("estagio") == stage)
    done = mine.where(F.col("status") == DONE).select("run_id")
    return (mine.where(F.col("status") == PREPARED).join(done, "run_id", "left_anti")
            .select("run_id", "dt", "tipo_carga", "iniciado_em"))


def refuse_older(runs: DataFrame, dt: str | None) -> None:
    """Raise if ``dt`` is older than the newest completed silver load.

    Its scope would take newer events for stale and delete them.
    """
    newest = (runs.where((F.col("estagio") == "silver") & (F.col("status") == DONE))
              .agg(F.max("dt").alias("m")).first()["m"])
    if dt is not None and newest is not None and dt < newest:
        raise ValueError(f"dt {dt} is older than the last silver load ({newest}); pass force=True")


def new_batch(dt: str | None = None) -> dict:
    """Batch identity, fixed once on the driver and passed into jobs as literals.

    ``dt`` defaults to today (UTC); ``run_id`` is 12 random hex digits;
    ``started_at`` is the UTC start time.
    """
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return {"dt": dt or now.strftime("%Y-%m-%d"), "run_id": uuid.uuid4().hex[:12], "started_at": now}

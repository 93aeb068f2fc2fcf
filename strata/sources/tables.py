"""Table sinks: typed output contracts, schema evolution, tables partitioned by id range.

Parquet has no MERGE and no transactions over several tables. A load is therefore
written whole to a staging folder first; a ledger row then says that it is prepared,
its partitions replace the tables' (dynamic partition overwrite), and a second ledger
row says that it is complete. A load that died in between is finished by the next one
from its staging folder, so a table is never left with half of a load for good.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

from strata.functions.dates import to_ddmmyyyy
from strata.sources import ledger

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def validate_name(name: str) -> str:
    """Schema/table names must be plain identifiers (guards generated SQL)."""
    if not _NAME.match(name or ""):
        raise ValueError(f"invalid schema name: {name!r}")
    return name


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{validate_name(name)}`")


def drop_tables(spark: SparkSession, database: str, tables: Sequence[str]) -> None:
    """Drop obsolete tables if they exist."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{validate_name(database)}`.`{validate_name(t)}`")


def to_contract(df: DataFrame, contract: Sequence[tuple[str, str]],
                date_text_cols: Sequence[str] = ("ingerido_em", "dt_particao"),
                drop: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto an output contract ``[(column, type), ...]``.

    * columns in ``drop`` are removed first (absent ones are ignored);
    * ``date_text_cols`` become ``dd/MM/yyyy`` text;
    * int columns use ``try_cast`` on text (bad ids -> null instead of an ANSI error) and a
      strict cast on numbers (one that does not fit is an error, never a null);
    * boolean flags become 0/1; missing contract columns become typed nulls.
    """
    df = df.drop(*drop)
    present = set(df.columns)
    out = []
    for name, dtype in contract:
        if name not in present:
            out.append(F.lit(None).cast(dtype).alias(name))
            continue
        c = F.col(name)
        src_type = dict(df.dtypes)[name]
        if name in date_text_cols:
            c = to_ddmmyyyy(c.cast("string"))
        elif src_type == "boolean" and dtype in ("int", "integer"):
            c = c.cast("int")
        elif dtype in ("int", "integer", "bigint", "double"):
            c = c.try_cast(dtype) if src_type == "string" else c.cast(dtype)
        elif src_type.startswith("timestamp") and dtype == "string":
            c = c.cast("string")
        else:
            c = c.cast(dtype)
        out.append(c.alias(name))
    return df.select(*out)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table with the declared schema (create-if-missing)."""
    return spark.createDataFrame([], schema)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become nulls."""
    return old.unionByName(new, allowMissingColumns=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on whatever filesystem holds ``path`` (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder of the shared file system in the place of another."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path(target), True)
    if not fs.rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def with_default(name: str, dtype: DataType, default: str | None = None) -> StructField:
    """A column that was added later: rows of older files have ``default`` (an SQL literal; none: null)."""
    return StructField(name, dtype, True, {} if default is None else {"CURRENT_DEFAULT": default, "EXISTS_DEFAULT": default})


class PartitionedTables:
    """Parquet tables under ``root``, those with an id partitioned by ranges of ``width`` ids.

    Ids are sequential, so what a load replaces lies in few ranges: reads prune to them and only
    they are written again. Rows without an id are never replaced; each load keeps its own in a
    partition of their own (a negative range). Loads of one ``root`` follow one another.
    """

    RANGE = "faixa_id"

    def __init__(self, spark: SparkSession, root: str, ledger_path: str | None = None, width: int = 1 << 22):
        self.spark = spark
        self.root = root
        self.width = width
        self.ledger_path = ledger_path or os.path.join(root, "_runs")

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def runs(self) -> DataFrame:
        if not path_exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], ledger.LEDGER_SCHEMA)
        return self.spark.read.schema(ledger.LEDGER_SCHEMA).parquet(self.ledger_path)

    # ---- reading

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """A table's rows. With ``schema`` columns that a file lacks have their default (see ``with_default``)
        and columns that it does not name are not read; without, the schema is that of all files together."""
        return self._read(self.path(table), table, schema).drop(self.RANGE)

    def _read(self, path: str, table: str, schema: StructType | None) -> DataFrame:
        if not path_exists(self.spark, path):
            if schema is None:
                raise FileNotFoundError(f"table {table!r} does not exist")
            return empty_like(self.spark, schema)
        if schema is None:
            return self.spark.read.option("mergeSchema", "true").parquet(path)
        return self.spark.read.schema(StructType([*schema.fields, StructField(self.RANGE, LongType())])).parquet(path)

    def ranges(self, df: DataFrame, id_col: str) -> DataFrame:
        """The distinct ranges of the ids of ``df`` (rows without an id have none)."""
        return (df.select(F.floor(F.col(id_col) / self.width).cast("bigint").alias(self.RANGE))
                .where(F.col(self.RANGE) >= 0).distinct())

    def read_ranges(self, table: str, ranges: DataFrame, schema: StructType) -> DataFrame:
        """A table's rows in ``ranges``; the partitions of all others are pruned when the join runs."""
        stored = self._read(self.path(table), table, schema)
        if self.RANGE not in stored.columns:
            return stored
        return stored.join(F.broadcast(ranges.where(F.col(self.RANGE) >= 0)), self.RANGE, "left_semi").drop(self.RANGE)

    # ---- a load: stage, commit (ledger row, overwrite, ledger row)

    def _staging(self, run_id: str, *names: str) -> str:
        return os.path.join(self.root, "_staging", f"run={run_id}", *names)

    def stage(self, run_id: str, table: str, df: DataFrame, id_col: str | None = None,
              touched: DataFrame | None = None) -> DataFrame:
        """Write what a load makes of a table to its staging folder; returns the rows written.

        Without ``touched`` they are the whole new table. With it (ranges) they are the whole new
        content of those ranges and of the load's rows without an id. AQE evens out the tasks that write.
        """
        path = self._staging(run_id, table)
        if touched is not None:
            touched.write.mode("overwrite").parquet(self._staging(run_id, "_touched", table))
        if id_col is None:
            df.write.mode("overwrite").parquet(path)
        else:
            earlier = self.runs().where((F.col("estagio") == "silver") & (F.col("status") == ledger.PREPARED))
            own = -1 - earlier.agg(F.count("*").alias("n")).first()["n"]
            at = F.coalesce(F.floor(F.col(id_col) / self.width), F.lit(own)).cast("bigint")
            (df.withColumn(self.RANGE, at).hint("rebalance", self.RANGE).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy(self.RANGE).parquet(path))
        return self.staged(run_id, table, df.schema)

    def staged(self, run_id: str, table: str, schema: StructType) -> DataFrame:
        """What a load has staged of a table."""
        return self.spark.read.schema(schema).parquet(self._staging(run_id, table))

    def commit(self, run: Mapping[str, object], staged: Mapping[str, tuple]) -> None:
        """Put a staged load in place: ``staged`` has the kind (``table``, ``ranges`` or ``plain``) and the schema of each table.

        The first ledger row makes the load one that will be finished, by this call or by ``recover``.
        """
        rows = [(t, kind, schema.json()) for t, (kind, schema) in staged.items()]
        (self.spark.createDataFrame(rows, "table_name string, kind string, columns string")
         .coalesce(1).write.mode("overwrite").parquet(self._staging(run["run_id"], "_tables")))
        self._record(run, ledger.PREPARED)
        self._finish(run)

    def recover(self) -> list[str]:
        """Finish loads that were prepared but not completed; returns their run ids."""
        unfinished = ledger.prepared_only(self.runs()).orderBy("iniciado_em", "run_id").collect()
        for run in unfinished:
            self._finish(run.asDict())
        return [r["run_id"] for r in unfinished]

    def _record(self, run: Mapping[str, object], status: str) -> None:
        ledger.record_run(self.spark, self.ledger_path, run["run_id"], run["dt"], run["tipo_carga"], "silver",
                          run["iniciado_em"], status)

    def _finish(self, run: Mapping[str, object]) -> None:
        tables_ = self.spark.read.parquet(self._staging(run["run_id"], "_tables")).collect()
        for t in sorted(tables_, key=lambda r: r["table_name"]):
            self._apply(run["run_id"], t["table_name"], t["kind"], StructType.fromJson(json.loads(t["columns"])))
        self._record(run, ledger.DONE)
        remove(self.spark, self._staging(run["run_id"]))

    def _apply(self, run_id: str, table: str, kind: str, schema: StructType) -> None:
        """Replace a table, or its touched ranges, by what is staged; doing so twice changes nothing."""
        path = self._staging(run_id, table)
        if kind == "plain":
            self.spark.read.schema(schema).parquet(path).write.mode("overwrite").parquet(self.path(table))
            return
        if kind == "table":
            # staged whole and as the table is laid out: moved, not written again; gone from staging once it is in place
            if path_exists(self.spark, path):
                move(self.spark, path, self.path(table))
            return
        staged = self._read(path, table, schema)
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.RANGE)
         .parquet(self.path(table)))
        # a range that lost all its rows is not among the staged ones: its partition is emptied
        touched = self.spark.read.parquet(self._staging(run_id, "_touched", table))
        emptied = touched.join(staged.select(self.RANGE).distinct(), self.RANGE, "left_anti").collect()
        for row in emptied:
            at = os.path.join(self.path(table), f"{self.RANGE}={row[self.RANGE]}")
            if path_exists(self.spark, at):
                empty_like(self.spark, schema).write.mode("overwrite").parquet(at)


def observed_write(df: DataFrame, name: str, path: str, fmt: str = "parquet",
                   extra_metrics: Sequence[Column] = ()) -> dict:
    """Write ``df`` and return its row count (and extra metrics) from the same pass."""
    return observed(df, name, lambda out: out.write.mode("overwrite").format(fmt).save(path), extra_metrics)


def observed(df: DataFrame, name: str, write, extra_metrics: Sequence[Column] = ()) -> dict:
    """Row count (and extra metrics) of ``df``, counted while ``write(df)`` writes it."""
    from pyspark.sql import Observation
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra_metrics))
    return obs.get

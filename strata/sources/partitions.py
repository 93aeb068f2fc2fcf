"""Dated JSON Lines partitions (``<base>/dt=YYYY-MM-DD/``).

Reads always take an explicit schema: JSON inference would turn a
``round -> stats`` map into a struct with one field per round, and numeric
looking text (ids, 5-digit hashes with leading zeros) must stay text.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from strata.sources import tables


CORRUPT = "_corrupt_record"
# Full microsecond precision (the JSON default keeps milliseconds only).
TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _with_dt(schema: StructType, dt_col: str = "dt") -> StructType:
    if dt_col in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(dt_col, StringType(), True)])


def read_partition(spark: SparkSession, base: str, dt: str, schema: StructType,
                   file_glob: str | None = None, out_col: str = "dt_particao",
                   mode: str = "FAILFAST") -> DataFrame:
    """One partition, read by path so a missing partition raises PATH_NOT_FOUND.

    (A ``dt`` filter on the whole base would silently return zero rows.)
    Blank lines are skipped; a malformed line fails the read (``FAILFAST``). ``read_quarantined``
    keeps going and keeps the bad lines.
    """
    reader = spark.read.schema(schema).options(**TS_OPTIONS).option("mode", mode)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.json(os.path.join(base, f"dt={dt}")).withColumn(out_col, F.lit(dt))


def read_all_partitions(spark: SparkSession, base: str, schema: StructType,
                        file_glob: str | None = None, out_col: str = "dt_particao",
                        mode: str = "FAILFAST") -> DataFrame:
    """Every partition with its ``dt`` as text (blank lines are skipped).

    Declaring ``dt`` as a string in the schema keeps partition discovery from
    turning it into a date. No partition at all raises, as an empty load would
    otherwise look like a successful one.
    """
    reader = spark.read.schema(_with_dt(schema)).options(**TS_OPTIONS).option("basePath", base).option("mode", mode)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    df = reader.json(os.path.join(base, "dt=*"))
    return df.withColumnRenamed("dt", out_col)


def read_quarantined(spark: SparkSession, base: str, schema: StructType, out: str,
                     dt: str | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Good rows, bad lines and their numbers, of one partition or all: (good, bad, counts).

    Lines are parsed once. Rows and lines are written to ``out``, apart from each other, and
    counted while that is done; both frames read from there. A line is bad if it is no JSON object
    or if one of its values does not fit the schema; ``bad`` has its whole text.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    day = _with_dt(full)
    reader = (spark.read.schema(full if dt else day).options(**TS_OPTIONS).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("basePath", base))
    parsed = reader.json(os.path.join(base, f"dt={dt}" if dt else "dt=*"))
    parsed = parsed.drop("dt").withColumn("dt", F.lit(dt)) if dt else parsed
    is_bad = F.col(CORRUPT).isNotNull()
    counts = tables.observed(parsed.withColumn("bad", is_bad), "lines",
                             lambda df: df.write.partitionBy("bad").parquet(out), [F.count_if(is_bad).alias("bad")])
    stored = spark.read.schema(StructType([*day.fields, StructField("bad", BooleanType(), True)])).parquet(out)
    good = stored.where(~F.col("bad")).select(*schema.fieldNames(), F.col("dt").alias("dt_particao"))
    bad = stored.where(F.col("bad")).select(F.col(CORRUPT).alias("line"), F.col("dt").alias("dt_particao"))
    return good, bad, {"good": counts["rows"] - counts["bad"], "bad": counts["bad"]}


def write_partition(df: DataFrame, base: str, dt: str) -> None:
    """Replace the one partition ``dt``; an empty batch leaves it there, empty."""
    (df.drop("dt").write.mode("overwrite").options(**TS_OPTIONS).json(os.path.join(base, f"dt={dt}")))


def write_partitions(df: DataFrame, base: str, dt_col: str = "dt") -> None:
    """Write JSON Lines by ``dt``, replacing only the partitions present in ``df``.

    An empty batch names no partition and replaces none; see ``write_partition``.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**TS_OPTIONS)
       .partitionBy(dt_col).json(base))

"""Sharding by extendible hashing: shards split bit by bit until each fits its byte limit.

A row's hash is 60 bits of the md5 of its id and text. The directory maps hash
prefixes to shards: a prefix is a shard if its rows fit the limit and those of
the prefix one bit shorter do not. So only oversized buckets split, and two
shards of a directory may differ in depth.

Byte sums are taken on *cells*, prefixes a few bits finer than the expected
shards, by a partial aggregation; coarser prefixes are sums of cells. Rows of
cells that are still too large go on alone with ``STEP`` more bits. The
directory is a table, joined by the cell; nothing is collected but two sums
and one look whether rows remain. Whole rows then meet the directory, with
all their columns, and ``write`` routes them: one folder and file a shard.
All of it is DataFrame operations.

Defined results: null or empty texts have 0 bytes; rows that repeat an id and
text have one hash, which no bit separates: beyond 60 bits they are dealt, by
their place in the written table, into ``part`` 0, 1, ... of that prefix; a
row larger than the limit is alone in its part. Null ids hash like any value.
Columns named like the result's (``write``: and ``shard``) are replaced, all
others stay. The input is read more than once and has to give the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.llm.common import written

MAX_BYTES = 1 << 20
BITS = 60
FINER = 3
STEP = 8
RESULT = ("bytes", "depth", "prefix", "part", "shard_bytes")


def hashed(docs: DataFrame) -> DataFrame:
    """(row, bytes, h) of every row; row: all its columns."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                       F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long").alias("h"))


def shard(docs: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """All rows and columns with bytes, depth, prefix, part and shard_bytes; prefix: the shard's bits as text."""
    whole = hashed(docs)
    rows = written(whole.select("bytes", "h"), "hashed")
    total = rows.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    low, high = 0, min(BITS, FINER + max(0, math.ceil(math.log2(max(1, total) / max_bytes))) if total > max_bytes else FINER)
    settled = []
    while True:
        cells = rows.groupBy(F.shiftright("h", BITS - high).alias("cell")).agg(F.sum("bytes").alias("n"))
        # every cell counts for its prefixes of low..high bits
        by_depth = cells.select("cell", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("d")).withColumn(
            "p", F.expr(f"shiftright(cell, {high} - d)"))
        sums = by_depth.groupBy("d", "p").agg(F.sum("n").alias("s"))
        fitting = by_depth.join(sums.where(F.col("s") <= max_bytes), ["d", "p"])
        directory = written(fitting.groupBy("cell").agg(
            F.min(F.struct("d", "p", "s")).alias("leaf")).select("cell", "leaf.d", "leaf.p", "leaf.s"), "directory")
        keyed = rows.withColumn("cell", F.shiftright("h", BITS - high))
        settled.append(whole.withColumn("cell", F.shiftright("h", BITS - high)).join(directory, "cell").select(
            "row", "bytes", F.col("d").alias("depth"), F.col("p").alias("p"), F.lit(0).cast("long").alias("part"),
            F.col("s").alias("shard_bytes")))
        rows = written(keyed.join(directory, "cell", "left_anti").drop("cell"), "oversized")
        if rows.isEmpty():
            break
        if high == BITS:
            alike = written(whole.join(rows.select("h").distinct(), "h", "left_semi").withColumn(
                "task", F.spark_partition_id()), "alike")
            settled.append(_dealt(alike, max_bytes))
            break
        low, high = high + 1, min(BITS, high + STEP)
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    bits = F.when(F.col("depth") == 0, "").otherwise(
        F.expr("lpad(bin(p), depth, '0')"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in RESULT]
    return out.select(*kept, "bytes", F.col("depth").cast("int").alias("depth"), bits.alias("prefix"), "part", "shard_bytes")


def _dealt(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Rows of equal hash, so of equal size: as many to a part as fit, numbered through the tasks that wrote them."""
    counts = rows.groupBy("h", "task").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("h").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("h", "task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    numbered = rows.withColumn("k", F.row_number().over(Window.partitionBy("h", "task").orderBy("bytes")) - 1).join(
        offsets, ["h", "task"])
    each = F.greatest(F.lit(1), F.floor(F.lit(max_bytes) / F.greatest(F.col("bytes"), F.lit(1)))).cast("long")
    parted = numbered.withColumn("part", F.floor((F.col("k") + F.col("ahead")) / each).cast("long"))
    sums = parted.groupBy("h", "part").agg(F.sum("bytes").alias("shard_bytes"))
    return parted.join(sums, ["h", "part"]).select(
        "row", "bytes", F.lit(BITS).alias("depth"), F.col("h").alias("p"), "part", "shard_bytes")


def write(docs: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> None:
    """Every row with its columns into its shard's folder under ``path``, as one file."""
    named = shard(docs, max_bytes).withColumn("shard", F.concat(F.lit("b"), "prefix", F.lit("-"), F.col("part").cast("string")))
    named.drop(*RESULT).repartition("shard").write.partitionBy("shard").parquet(path)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``shard``, for rows of ``schema`` and taken from what the shards hold."""
    columns = [f for f in schema if f.name.lower() not in (*RESULT, "shard")]
    rows = spark.read.schema(StructType([*columns, StructField("shard", StringType())])).parquet(path).withColumn(
        "bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    sums = rows.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"))
    prefix = F.regexp_extract("shard", "^b([01]*)-", 1)
    return rows.join(sums, "shard").select(
        *[F.col(f"`{f.name}`") for f in columns], "bytes", F.length(prefix).alias("depth"), prefix.alias("prefix"),
        F.regexp_extract("shard", "-([0-9]+)$", 1).cast("long").alias("part"), "shard_bytes")


def oracle(max_bytes: int = MAX_BYTES) -> str:
    """DuckDB SQL for the result of ``shard``; rows of one hash that do not fit are equal in all that it returns."""
    return f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, {BITS // 4}))::BIGINT AS h,
         row_number() OVER () AS r
  FROM documents),
s AS (
  SELECT d, h >> ({BITS} - d) AS p, sum(bytes) AS s
  FROM r, range(0, {BITS + 1}) AS t(d) GROUP BY ALL),
leaf AS (
  SELECT r.r, min(d)::INTEGER AS depth, max(s) AS shard_bytes
  FROM r, s WHERE s.p = r.h >> ({BITS} - s.d) AND s.s <= {max_bytes} GROUP BY r.r),
dealt AS (
  SELECT r.r, r.h, r.bytes,
         ((row_number() OVER (PARTITION BY r.h ORDER BY r.r) - 1) // greatest(1, {max_bytes} // greatest(1, r.bytes)))::BIGINT AS part
  FROM r ANTI JOIN leaf ON r.r = leaf.r),
placed AS (
  SELECT r, depth, 0::BIGINT AS part, shard_bytes FROM leaf
  UNION ALL
  SELECT r, {BITS}, part, sum(bytes) OVER (PARTITION BY h, part) FROM dealt)
SELECT doc_id, bytes, depth,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> ({BITS} - depth)), depth, '0') END AS prefix,
       part, shard_bytes::BIGINT AS shard_bytes
FROM r JOIN placed USING (r)
"""


#: The SQL of the registered query.
ORACLE = oracle()

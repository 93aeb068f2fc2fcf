"""Stable sequential surrogate keys.

Only new natural keys receive ids, numbered ``max(existing) + 1, + 2, ...``
in natural-key order; existing ids never change. Numbering is distributed and
moves the key columns alone: they are written once (so the input is evaluated
once), range-partitioned and sorted, and each row's position in its partition
is written to a table in the shared checkpoint folder (so a lost executor
cannot re-number anything: positions are read back, never recomputed). The
partitions' offsets are a table too, running sums over one row per partition,
and other columns are joined back by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import workspace_path


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def max_id(dim: DataFrame | None, id_col: str) -> int:
    """Largest id in a dimension (0 when empty). One scalar to the driver."""
    if dim is None:
        return 0
    row = dim.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def number_rows(df: DataFrame, order_by: Sequence, id_col: str, start_after: int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """Assign ``start_after + 1 ..`` to the rows of ``df`` in ``order_by`` order.

    ``order_by`` must be a total order over the rows (e.g. a distinct key). If it
    is columns by name, only they are written and sorted.
    """
    spark = df.sparkSession
    order = _cols(order_by)
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    by_name = all(isinstance(x, str) for x in names)
    source = _written(df.select(*names) if by_name else df, "to-number")
    ranged = source.repartitionByRange(num_partitions, *order) if num_partitions else source.repartitionByRange(*order)
    staged = _written(
        ranged.sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)), "numbered")
    before = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy("_pid").agg(F.count("*").alias("_n")).select(  # one row per partition
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = (staged.join(offsets, "_pid")
                .withColumn(id_col, (F.lit(start_after) + F.col("_off") + F.col("_pos") + 1).cast("bigint"))
                .drop("_pid", "_pos", "_off"))
    others = [c for c in df.columns if c not in names]
    if not by_name or not others:
        return numbered
    left, right = df.alias("_rows"), numbered.select(*[F.col(n).alias(f"_key_{n}") for n in names], id_col)
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"_rows.{n}").eqNullSafe(F.col(f"_key_{n}"))
    return left.join(right, same).drop(*[f"_key_{n}" for n in names])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = workspace_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def missing_keys(candidates: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not yet in the dimension (null keys excluded).

    ``left_anti`` rather than ``NOT IN``: one null key on the right would empty
    a ``NOT IN`` result.
    """
    return candidates.where(F.col(key).isNotNull()).join(current.select(key), key, "left_anti")


def assign_new_ids(candidates: DataFrame, current: DataFrame | None, key: str, id_col: str) -> DataFrame:
    """Rows of ``candidates`` missing from ``current`` with fresh sequential ids."""
    new = candidates if current is None else missing_keys(candidates, current, key)
    if current is None:
        new = new.where(F.col(key).isNotNull())
    base = max_id(current, id_col)
    out = number_rows(new, [key], id_col, start_after=base)
    return out.select(id_col, *[c for c in out.columns if c != id_col])

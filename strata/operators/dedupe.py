"""Keep-one-per-key operators and in-group positions.

``row_number() == 1`` / ``<= n`` over a key lets Spark plan a
``WindowGroupLimit`` on the map side, so each input partition ships at most
n rows per key into the shuffle: a key holding a third of all rows costs
one row per map task, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def content_hash(df: DataFrame) -> Column:
    """Deterministic last tie-breaker: a hash of the whole row's content.

    Read order is not stable across re-reads or task retries; a content hash
    is, so a retried task after an executor loss keeps the same row. (Columns
    with maps have no hash of their own; they are hashed as JSON text.)
    """
    return F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name)
                        for f in df.schema.fields])


def first_per_key(df: DataFrame, key, order_by: Sequence) -> DataFrame:
    """Keep the first row per key under an explicit total order.

    A null key is one group, so exactly one null-key row survives.
    """
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_keys(df: DataFrame, key, order_by: Sequence, n: int = 0) -> DataFrame:
    """First row per key, in order of first appearance; ``n`` > 0: only the first ``n`` keys."""
    firsts = first_per_key(df, key, order_by)
    return firsts.orderBy(*_cols(order_by)).limit(n) if n else firsts


def latest_per_key(df: DataFrame, key, ts: str | Column, tiebreak: Sequence = ()) -> DataFrame:
    """Latest version per key: timestamp descending with unparseable/missing last.

    String timestamps are parsed with ``try_to_timestamp`` so bad values sort
    last instead of failing. Ties fall back to ``tiebreak`` (read order).
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    if isinstance(ts, str):
        dtype = dict(df.dtypes)[ts]
        if dtype == "string":
            t = F.try_to_timestamp(t)
    return first_per_key(df, key, [t.desc_nulls_last(), *_cols(tiebreak)])


def top_n_per_key(df: DataFrame, key, order_by: Sequence, n: int) -> DataFrame:
    """First n rows per key (n is the feature, e.g. first bouts of a card)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_non_null(df: DataFrame, key, values: Sequence[str], order: Sequence) -> DataFrame:
    """Per key, the first non-null value of each column under ``order``.

    ``min_by(v, when(v is not null, ord))`` skips rows whose value is null
    (a null ordering value never wins), and is a partial aggregate, so hot
    keys are combined map-side.
    """
    ordering = F.struct(*_cols(order))
    aggs = [F.min_by(F.col(v), F.when(F.col(v).isNotNull(), ordering)).alias(v) for v in values]
    return df.groupBy(*_cols(key)).agg(*aggs)


def explode_with_position(df: DataFrame, array_col: str, pos_col: str, value_col: str,
                          keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element with its 1-based position (no shuffle)."""
    return df.select(*keep, F.posexplode(array_col).alias("_p", value_col)) \
             .withColumn(pos_col, F.col("_p") + 1).drop("_p")

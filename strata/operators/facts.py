"""Id attachment, nested collection and the nested fact (explode) operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.codes import digits_to_int
from strata.functions.nested import round_keys
from strata.operators.dedupe import first_per_key


# Partitions' worth of rows that a key without a match is spread to.
SPREAD = 4096


def attach_ids(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left lookups natural key -> surrogate id(s); ids are moved to the front.

    Dimensions have unique keys, so a left join never multiplies rows. The
    join strategy is left to AQE: a dimension below the broadcast threshold is
    broadcast at runtime, a large one is sort-merge joined.
    """
    out, ids = df, []
    for dim, key, id_cols in lookups:
        out = out.join(dim.select(key, *id_cols), key, "left")
        ids.extend(id_cols)
    return out.select(*ids, *[c for c in out.columns if c not in ids])


def collect_nested(df: DataFrame, parent: Sequence[str], entry_key: str, value: Column,
                   order: Sequence, map_col: str) -> DataFrame:
    """Per parent, a map ``entry_key -> value``; on duplicate keys the last row wins.

    Duplicates are reduced first (``first_per_key`` under the reversed total
    order), because ``map_from_entries`` rejects duplicate keys. Each group is
    bounded by its number of distinct entry keys.
    """
    keyed = df.withColumn("_k", F.col(entry_key).cast("string")).withColumn("_v", value)
    last = first_per_key(keyed, [*parent, "_k"], [o.desc() if isinstance(o, Column) else F.col(o).desc()
                                                  for o in order])
    return (last.groupBy(*parent)
            .agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias(map_col)))


def nested_fact(parents: DataFrame, parent_key: str, parent_dim: DataFrame, parent_ids: Sequence[str],
                members_col: str, member_key: str, member_dim: DataFrame, member_id: str,
                rounds_field: str, total_col: str, parent_cols: Sequence[tuple[str, str]],
                member_cols: Sequence[tuple[str, str]], stat_fields: Sequence[str],
                round_col: str = "round_num", total_out: str = "round_final") -> DataFrame:
    """Parent x member x round rows.

    * parents without a key or absent from ``parent_dim`` are dropped (inner join),
      and so are parents with no members;
    * members are looked up in ``member_dim`` (left join: unknown -> null id);
    * rounds: the member's map keys in natural order; an empty map falls back
      to ``1..total`` and, failing that, one row with a null round;
    * stats come from a null-safe map lookup (missing key -> null stats).
    """
    p = parents.where(F.col(parent_key).isNotNull()).join(parent_dim.select(parent_key, *parent_ids),
                                                          parent_key, "inner")
    p = p.where(F.coalesce(F.size(members_col), F.lit(0)) > 0)
    m = p.select(*parent_ids, *[F.col(c) for c, _ in parent_cols], F.col(total_col).alias("_total"),
                 F.explode(members_col).alias("_m"))
    # members without a key match nothing: a second join column spreads them over all partitions
    salt = F.when(F.col("_mk").isNull(), F.pmod(F.xxhash64(*parent_ids, *[F.col(c) for c, _ in parent_cols]), F.lit(SPREAD)))
    m = m.withColumn("_mk", F.col(f"_m.{member_key}")).withColumn("_salt", F.coalesce(salt.cast("int"), F.lit(0)))
    m = m.join(member_dim.select(F.col(member_key).alias("_mk"), F.lit(0).alias("_salt"), member_id), ["_mk", "_salt"], "left")
    r = m.withColumn("_rk", F.explode(round_keys(F.col(f"_m.{rounds_field}"), F.col("_total"))))
    r = r.withColumn("_s", F.when(F.col("_rk").isNotNull(),
                                  F.try_element_at(F.col(f"_m.{rounds_field}"), F.col("_rk"))))
    return r.select(
        member_id, *parent_ids,
        *[F.col(f"_m.{src}").alias(dst) for src, dst in member_cols],
        *[F.col(src).alias(dst) for src, dst in parent_cols],
        F.col("_total").cast("string").alias(total_out),
        digits_to_int(F.col("_rk")).alias(round_col),
        *[F.col(f"_s.{s}").alias(s) for s in stat_fields],
    )

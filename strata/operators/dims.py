"""Dimension upserts (slowly changing, type 1) without per-row UPDATEs.

Stored rows go through one left join with the candidates (untouched when no
candidate matches, updated by rule when one does); new rows come from a
key-only anti join and are numbered by ``keys.number_rows``. The two parts
are consumed by different jobs (new ids are written first), so the wide
dimension is joined once and only key columns are shuffled a second time.
Rows are never deleted and ``created`` is set once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.codes import BONUS_SEED, bonus_label
from strata.functions.text import ustrip
from strata.operators.keys import max_id, number_rows


def _ts(now) -> Column:
    """Run timestamp: one literal per batch (never a per-row clock)."""
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def changed(new: Column, old: Column, trim: bool) -> Column:
    """New value is non-empty and differs from the old one (or ''); ``trim``: white space around it aside."""
    old_v = F.coalesce(old, F.lit(""))
    if trim:
        differs = ustrip(old_v) != ustrip(new)
    else:
        differs = old_v != new
    return F.coalesce(new.isNotNull() & (new != "") & differs, F.lit(False))


def upsert_dimension(current: DataFrame, candidates: DataFrame, key: str, id_col: str,
                     attrs: Sequence[str], mode: str, now: Column | str,
                     trim_compare: Mapping[str, bool] | None = None,
                     created_col: str = "criado_em", updated_col: str = "atualizado_em") -> DataFrame:
    """Merge ``candidates`` (one row per key) into ``current``.

    mode="changed": a matched row is updated only when some attribute changed
    (non-empty and different); each attribute becomes ``coalesce(new, old)`` and
    ``updated`` is bumped. mode="always": matched rows take the candidate
    values as they are (nulls included) and ``updated`` is always bumped.
    """
    if mode not in ("changed", "always"):
        raise ValueError(f"unknown upsert mode: {mode}")
    now_c = _ts(now)
    trim_compare = dict(trim_compare or {})
    cand = candidates.where(F.col(key).isNotNull()).select(
        key, *[F.col(a).alias(f"_new_{a}") for a in attrs], F.lit(True).alias("_in_cand"))
    cur = current.select(id_col, key, *attrs, created_col, updated_col)
    both = cur.join(cand, key, "left")
    in_cand = F.coalesce(F.col("_in_cand"), F.lit(False))

    if mode == "changed":
        any_change = F.lit(False)
        for a in attrs:
            any_change = any_change | changed(F.col(f"_new_{a}"), F.col(a), trim_compare.get(a, False))
        upd = in_cand & any_change
        new_vals = {a: F.when(upd, F.coalesce(F.col(f"_new_{a}"), F.col(a))).otherwise(F.col(a)) for a in attrs}
    else:
        upd = in_cand
        new_vals = {a: F.when(upd, F.col(f"_new_{a}")).otherwise(F.col(a)) for a in attrs}

    kept = both.select(id_col, key, *[new_vals[a].alias(a) for a in attrs], created_col,
                       F.when(upd, now_c).otherwise(F.col(updated_col)).alias(updated_col))
    fresh = (cand.join(current.select(key), key, "left_anti")
             .select(key, *[F.col(f"_new_{a}").alias(a) for a in attrs]))
    numbered = number_rows(fresh, [key], id_col, start_after=max_id(current, id_col))
    numbered = numbered.select(id_col, key, *attrs, now_c.alias(created_col), now_c.alias(updated_col))
    id_type = dict(current.dtypes)[id_col]
    return kept.unionByName(numbered.withColumn(id_col, F.col(id_col).cast(id_type)))


def code_candidates(observed_codes: DataFrame, code_col: str) -> DataFrame:
    """Seed codes plus every distinct non-null observed code, with labels."""
    spark = observed_codes.sparkSession
    seed = spark.range(1, len(BONUS_SEED) + 1).select(F.col("id").cast("int").alias(code_col))
    seed = seed.where(F.col(code_col).isin(BONUS_SEED))
    observed = observed_codes.select(F.col(code_col).try_cast("int").alias(code_col)).where(F.col(code_col).isNotNull())
    codes = observed.union(seed).distinct()
    return codes.withColumn("descricao_bonus", bonus_label(code_col))


def upsert_code_dimension(current: DataFrame, observed_codes: DataFrame, code_col: str, now) -> DataFrame:
    """Code dimension: insert missing codes, refresh labels that differ (trimmed).

    The code itself is the key, so there is no surrogate numbering.
    """
    now_c = _ts(now)
    cand = code_candidates(observed_codes, code_col).select(code_col, F.col("descricao_bonus").alias("_new"))
    cur = current.select(code_col, "descricao_bonus", "criado_em", "atualizado_em", F.lit(True).alias("_in_cur"))
    both = cur.join(cand, code_col, "full_outer")
    in_cur = F.coalesce(F.col("_in_cur"), F.lit(False))
    upd = in_cur & changed(F.col("_new"), F.col("descricao_bonus"), trim=True)
    return both.select(
        code_col,
        F.when(~in_cur, F.col("_new")).when(upd, F.col("_new")).otherwise(F.col("descricao_bonus")).alias("descricao_bonus"),
        F.when(in_cur, F.col("criado_em")).otherwise(now_c).alias("criado_em"),
        F.when(~in_cur | upd, now_c).otherwise(F.col("atualizado_em")).alias("atualizado_em"),
    )

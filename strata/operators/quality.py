"""Data-quality checks that a database would otherwise enforce.

Checks return violation rows ``(rule, column, key, detail)``; an empty result
means the table passes. ``enforce`` runs on staged versions before they are
made current and keeps every violation in a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VIOLATION_COLS = ["rule", "column_name", "key_value", "detail"]


def _key_text(cols: Sequence[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def key_not_null(df: DataFrame, key: str) -> DataFrame:
    """Rows that have a key, null and empty text being none (the guard before dimension building)."""
    present = F.col(key).isNotNull()
    return df.where(present & (F.col(key) != "") if dict(df.dtypes)[key] == "string" else present)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (UNIQUE / PRIMARY KEY)."""
    return (df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
            .select(F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"),
                    _key_text(keys).alias("key_value"), F.col("_n").cast("string").alias("detail")))


def row_violations(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = (),
                   max_len: Mapping[str, int] | None = None, flag_null: Sequence[str] = ()) -> DataFrame:
    """Broken NOT NULL and length rules, all of a table in one pass; ``flag_null``: reported as ``null_id``."""
    def row(rule: str, col: str, detail):
        return F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column_name"), _key_text(key).alias("key_value"),
                        detail.cast("string").alias("detail"))
    found = [F.when(F.col(c).isNull(), row("not_null", c, F.lit(None))) for c in not_null]
    found += [F.when(F.col(c).isNull(), row("null_id", c, F.lit(None))) for c in flag_null]
    found += [F.when(F.length(c) > n, row("max_len", c, F.length(c))) for c, n in (max_len or {}).items()]
    return df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("_v")).select("_v.*")


def violations(df: DataFrame, key: Sequence[str], unique: Sequence[Sequence[str]] = (),
               not_null: Sequence[str] = (), max_len: Mapping[str, int] | None = None,
               flag_null: Sequence[str] = ()) -> DataFrame:
    parts = [duplicate_keys(df, u) for u in unique]
    if not_null or max_len or flag_null:
        parts.append(row_violations(df, key, not_null, max_len, flag_null))
    if not parts:
        raise ValueError("no rules given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(frames: Mapping[str, DataFrame], rules: Mapping[str, Mapping], path: str) -> None:
    """Write every violation of the tables' rules to ``path``; raise with their number if any blocks.

    Rows with a null id (``null_id``) are written but do not block.
    """
    out = None
    for table, df in frames.items():
        part = violations(df, **rules[table]).select(F.lit(table).alias("table_name"), *VIOLATION_COLS)
        out = part if out is None else out.unionByName(part)
    out.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(out.schema).parquet(path)
    by_rule = {(r["table_name"], r["rule"]): r["n"] for r in  # at most one row per table and rule
               written.where("rule <> 'null_id'").groupBy("table_name", "rule").agg(F.count("*").alias("n")).collect()}
    if by_rule:
        raise ValueError(f"{sum(by_rule.values())} data-quality violations, all of them in {path}: {by_rule}")

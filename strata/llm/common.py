"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ship_package, workspace_path


def whole_text(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ship_package(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a fresh table in the shared folder and read it back."""
    spark = df.sparkSession
    path = workspace_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``df`` has that name."""
    have = {c.lower() for c in df.columns}
    while wish.lower() in have:
        wish += "_"
    return wish


def whole_groups(batches, key: str):
    """Arrow batches sorted by ``key``, re-cut so that no run of equal keys spans two tables."""
    import pyarrow as pa

    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table_ = pa.Table.from_batches([batch])
        if held is not None:
            table_ = pa.concat_tables([held, table_])
        keys = table_.column(key).to_numpy()
        # first row of the last run: it may go on in the next batch
        cut = len(keys) - 1
        last = keys[cut]
        while cut > 0 and keys[cut - 1] == last:
            cut -= 1
        if cut:
            yield table_.slice(0, cut).combine_chunks()
        held = table_.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def by_key(table_, key: str):
    """(key, rows) of each run of equal keys in a table sorted by ``key``."""
    keys = table_.column(key).to_numpy()
    begin = 0
    for end in range(1, len(keys) + 1):
        if end == len(keys) or keys[end] != keys[begin]:
            yield keys[begin], table_.slice(begin, end - begin)
            begin = end

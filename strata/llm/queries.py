"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds
DuckDB SQL for those that SQL expresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (collocations, fingerprint, neardup, packing, pii, pq, quality, search, sharding, tokenfile, triebpe,
                        warc, weakrules)
from strata.llm.common import table
from strata.session import workspace_path


def tokenizer() -> str:
    """The tokenizer file of the queries (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.encode_and_read(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer())


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(pii.joined(base), 256).alias("base_sha256"),
                        pii.joined(F.col("pii")).alias("spans"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("complete")


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triebpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer())


def op8_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.link(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), workspace_path(spark, "shards")
    sharding.write(docs, path)
    return sharding.read(spark, path, docs.schema).select("doc_id", "bytes", "depth", "prefix", "part", "shard_bytes")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weakrules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_pii": op2_pii,
    "op3_minhash_neardup": op3_minhash_neardup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_prefix_fingerprints": op5_prefix_fingerprints,
    "op6_warc_segments": op6_warc_segments,
    "op7_trie_bpe": op7_trie_bpe,
    "op8_pq_neardup": op8_pq_neardup,
    "op9_extendible_sharding": op9_extendible_sharding,
    "op10_packing": op10_packing,
    "op11_weak_rules": op11_weak_rules,
    "op12_collocations": op12_collocations,
    "op13_nra_search": op13_nra_search,
}

ORACLES: dict = {
    "op9_extendible_sharding": sharding.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_nra_search": search.ORACLE,
}

"""Token ids in binary files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus (0: the most frequent; ties by id),
so that small numbers are common. Ranks are stored in 1 to 4 little-endian
bytes; two bits each, four ranks to a control byte, say how many. Control
bytes and data bytes lie apart, so that a reader finds all positions with one
table look-up by control byte and a running sum, and then gathers the ranks.

A corpus is a folder with

* ``ids``: binary files in ascending doc_id order, each a sequence of blocks.
  A block holds whole documents, at least one, up to about ``BLOCK`` ids, and
  says its shard, its number there, its documents' ids and lengths. A block
  ends with a line feed, which its length does not count.
* ``ranks``: a Parquet table (rank, id, occurrences), at most as long as the
  vocabulary.

The files are written and read through Spark's own readers and writers, so any
file system that Spark reaches will do and a lost task leaves no half file.
The whole order comes from a range partitioning by doc_id; positions in the
corpus are sums of the shards' totals.

Defined results: a null or empty text has the end id alone; rows that repeat a
doc_id follow each other by their ids' checksum; null doc_ids come first; an
empty table makes an empty corpus.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, written
from strata.llm.units import id_bytes, library_encoder
from strata.session import workspace_path

END = 0
BLOCK = 1 << 16
BLOCKS_A_FILE = 128
MAGIC = b"RVB1"
# magic, bytes that follow, shard, block, documents, ids, data bytes
HEADER = struct.Struct("<4sQIIIQQ")

#: For each control byte the byte counts of its four ranks.
WIDTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple:
    """(control bytes, data bytes) of non-negative 32-bit ranks."""
    ranks = ranks.astype("<u4")
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    keep = np.arange(4, dtype=np.uint8)[None, :] <= code[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks again: widths by table look-up, positions by a running sum, then a gather."""
    width = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(width, dtype=np.int64)
    at = ends - width
    source = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    ranks = source[at]
    for k in (1, 2, 3):
        more = np.flatnonzero(width > k)
        ranks[more] |= source[at[more] + k] << np.uint32(8 * k)
    return ranks


def _tokenized(path: str, end: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = library_encoder(path), zstandard.ZstdCompressor(level=1)
        close = np.array([end], "<u4").tobytes()
        counts = np.zeros(size, np.int64)
        for batch in batches:
            lengths, crcs, blobs = [], [], []
            for raw in id_bytes(encoder, batch.column("text")):
                raw += close
                ids = np.frombuffer(raw, "<u4")
                counts += np.bincount(ids, minlength=size) if len(ids) > size // 8 else 0
                if len(ids) <= size // 8:
                    np.add.at(counts, ids, 1)
                lengths.append(len(ids))
                crcs.append(zlib.crc32(raw))
                narrow = ids.astype("<u2") if size <= 1 << 16 else ids
                blobs.append(squeeze.compress(narrow.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array(blobs, pa.binary()), pa.nulls(len(lengths), pa.list_(pa.int64()))],
                names=["doc_id", "n_tokens", "crc", "ids", "counts"])
        # one more row a task: how often each id occurred in it
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([counts], pa.list_(pa.int64()))], names=["doc_id", "n_tokens", "crc", "ids", "counts"])

    return run


def _block(shard: int, number: int, docs: list, lengths: list, ranks: list) -> bytes:
    every = np.concatenate(ranks)
    control, data = encode_ranks(every)
    known = np.array([d is not None for d in docs], np.uint8).tobytes()
    body = (np.array([d or 0 for d in docs], "<i8").tobytes() + known + np.array(lengths, "<u8").tobytes()
            + control + data)
    return HEADER.pack(MAGIC, len(body), shard, number, len(docs), len(every), len(data)) + body


def _blocks(rank_of: np.ndarray, narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, grow = TaskContext.get().partitionId(), 0, zstandard.ZstdDecompressor()
        docs, lengths, ranks, held = [], [], [], 0
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array([_block(shard, number, docs, lengths, ranks)], pa.binary())], names=["block"])
        for batch in batches:
            for doc, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(grow.decompress(blob.as_py()), "<u2" if narrow else "<u4")
                if docs and held + len(ids) > BLOCK:
                    yield out()
                    number, docs, lengths, ranks, held = number + 1, [], [], [], 0
                docs.append(doc)
                lengths.append(len(ids))
                ranks.append(rank_of[ids])
                held += len(ids)
        if docs:
            yield out()

    return run


def write(docs: DataFrame, path: str, folder: str, end: int = END) -> None:
    """Encode all texts with the tokenizers library and write the corpus to ``folder``."""
    from tokenizers import Tokenizer

    prepare(docs.sparkSession)
    size = max(Tokenizer.from_file(path).get_vocab().values()) + 1
    spark = docs.sparkSession
    tokens = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tokenized(path, end, size),
        "doc_id long, n_tokens long, crc long, ids binary, counts array<long>"), "tokens")
    counted = (tokens.where(F.col("counts").isNotNull()).select(F.posexplode("counts").alias("id", "n"))
               .where("n > 0").groupBy("id").agg(F.sum("n").alias("occurrences")).collect())  # at most the vocabulary
    order = sorted((-r["occurrences"], r["id"]) for r in counted)
    (spark.createDataFrame([(k, i, -n) for k, (n, i) in enumerate(order)], "rank int, id int, occurrences long")
     .coalesce(1).write.parquet(f"{folder}/ranks"))
    rank_of = np.zeros(size, np.uint32)
    rank_of[[i for _, i in order]] = np.arange(len(order), dtype=np.uint32)
    (tokens.where(F.col("ids").isNotNull()).select("doc_id", "crc", "ids")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "crc").select("doc_id", "ids")
     .mapInArrow(_blocks(rank_of, size <= 1 << 16), "block binary")
     # the writer takes any bytes as a line and ends it with a line feed
     .select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", BLOCKS_A_FILE).text(f"{folder}/ids"))


def parse(content: bytes):
    """(shard, block, doc_ids with None for null, lengths, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        magic, size, shard, number, docs, count, data = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEADER.size
        ids = np.frombuffer(content, "<i8", docs, at)
        known = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
        lengths = np.frombuffer(content, "<u8", docs, at + 9 * docs).astype(np.int64)
        body = at + 17 * docs
        end = body + -(-count // 4)
        if end + data != at + size:
            raise ValueError(f"the block at byte {at} has a wrong length")
        ranks = decode_ranks(content[body:end], content[end:end + data], count)
        yield shard, number, [int(d) if k else None for d, k in zip(ids, known)], lengths, ranks
        at += size + 1


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a corpus, in any row order.

    ``start``: ids of all documents before it. ``with_ids=False`` leaves out the ids.
    """
    prepare(spark)
    ranks = spark.read.parquet(f"{folder}/ranks").select("rank", "id").collect()  # at most the vocabulary
    id_of = np.zeros(max([r["rank"] for r in ranks], default=-1) + 1, "<u4")
    for r in ranks:
        id_of[r["rank"]] = r["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for shard, number, docs, lengths, found in parse(content.as_py()):
                    ids = id_of[found]
                    ends = np.cumsum(lengths)
                    begins = ends - lengths
                    raw = ids.tobytes()
                    crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    columns = [pa.array([shard] * len(docs), pa.int32()), pa.array([number] * len(docs), pa.int32()),
                               pa.array(docs, pa.int64()), pa.array(begins), pa.array(lengths), pa.array(crcs, pa.int64())]
                    names = ["shard", "block", "doc_id", "begin", "n_tokens", "ids_crc32"]
                    if with_ids:
                        offsets = np.concatenate([[0], ends]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard int, block int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    files = spark.read.format("binaryFile").load(f"{folder}/ids").select("content")
    docs = files.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
    if not with_ids:
        docs = written(docs, "read")
    # totals by block are few rows against the ids; blocks are summed inside their shard, then shards
    totals = docs.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    shards = totals.groupBy("shard").agg(F.sum("n").alias("n"))
    ahead = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.withColumn("inside", F.coalesce(F.sum("n").over(ahead("shard", "block")), F.lit(0))).join(
        shards.withColumn("first", F.coalesce(F.sum("n").over(ahead(F.lit(0), "shard")), F.lit(0))).drop("n"),
        "shard").select("shard", "block", (F.col("inside") + F.col("first")).alias("ahead"))
    return docs.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("ahead") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))


def encode_and_read(docs: DataFrame, path: str) -> DataFrame:
    """Write the corpus to a fresh folder and return what the files say of each document."""
    folder = workspace_path(docs.sparkSession, "corpus")
    write(docs, path, folder)
    return read(docs.sparkSession, folder, with_ids=False)

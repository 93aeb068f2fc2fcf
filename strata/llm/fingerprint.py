"""Document fingerprints from prefix polynomial hashes.

For a text of code points c, ``PrefixHash`` keeps the running sums
S[k] = sum of (c[i] + 1) * B^i for i < k, modulo the prime 2^31 - 1, for two
bases. Any span's hash is a difference of two of them times a power: spans of
any two texts compare in constant time, and the longest common extension of
two positions is a binary search over lengths.

A fingerprint is the text's length, the hash of the whole text, and the
``KEEP`` smallest hashes (after mixing) of its spans of ``SPAN`` code points;
the spans that end in the first places are shorter, so that every text has as
many as code points. The likeness of two fingerprints estimates the share of
spans that the texts have in common, from the fingerprints alone.

``neighbours`` compares every document with an edited copy, whose last third is
replaced by the start of the next document in descending doc_id order, and
with that document. All three fingerprints come from the arrays of the two
texts; the edited text is not hashed again except where its parts meet.

Order: texts are dealt once, to buckets of consecutive ids whose bounds are
quantiles; the first document of every bucket is also sent to the bucket
before, so that each bucket is worked through alone, as a stream.

Defined results: a null text counts as empty; empty texts have no spans, are
alike (1) and unlike all others (0). Rows that repeat a doc_id follow each
other by text; null doc_ids come last; a document alone is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, written

PRIME = (1 << 31) - 1
BASES = (1_000_003, 754_974_731)
SPAN = 8
KEEP = 48
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for 0 <= x < 2^62: high bits count like low ones."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


class _Powers:
    """Powers of a base and of its inverse, as far as needed so far."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, PRIME - 2, PRIME))
        self.tables = [np.ones(1, np.int64), np.ones(1, np.int64)]

    def upto(self, n: int) -> list:
        for which, step in enumerate(self.steps):
            known = self.tables[which]
            while len(known) <= n:
                known = np.concatenate([known, _mod(known * pow(step, len(known), PRIME))])
            self.tables[which] = known
        return self.tables


_POWERS = tuple(_Powers(b) for b in BASES)


class PrefixHash:
    """Prefix hash arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        self.n = len(codes)
        self.sums = []
        for powers in _POWERS:
            power, _ = powers.upto(self.n + SPAN)
            sums = np.zeros(self.n + 1, np.int64)
            np.cumsum(_mod(codes * power[:self.n]), out=sums[1:])  # below 2^31 each: no overflow
            self.sums.append(_mod(sums))

    def span(self, start: int, end: int) -> tuple:
        """Hash of text[start:end], the same wherever the span lies."""
        return tuple(int((int(s[end]) - int(s[start])) % PRIME * int(p.upto(self.n + SPAN)[1][start]) % PRIME)
                     for s, p in zip(self.sums, _POWERS))

    def equal(self, start: int, other: PrefixHash, at: int, length: int) -> bool:
        """Whether both texts hold the same ``length`` code points there (as far as they reach)."""
        if start + length > self.n or at + length > other.n:
            return False
        return self.span(start, start + length) == other.span(at, at + length)

    def common_extension(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common span from both positions, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self) -> np.ndarray:
        """For each end 1..n the mixed hash of the (up to) ``SPAN`` code points before it."""
        ends = np.arange(1, self.n + 1)
        starts = np.maximum(ends - SPAN, 0)
        return _mixed([self._between(k, starts, ends) for k in (0, 1)])

    def _between(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums from starts to ends, as if each span of SPAN places ended at SPAN."""
        power, inverse = _POWERS[which].upto(self.n + SPAN)
        sums = self.sums[which]
        difference = sums[ends] - sums[starts]
        difference = np.where(difference < 0, difference + PRIME, difference)
        shift = ends - SPAN  # negative for the first, shorter spans
        factor = np.where(shift >= 0, inverse[np.maximum(shift, 0)], power[np.maximum(-shift, 0)])
        return _mod(difference * factor)


def _mixed(hashes: list) -> np.ndarray:
    joined = (hashes[0].astype(np.uint64) << np.uint64(31)) | hashes[1].astype(np.uint64)
    joined = (joined ^ (joined >> np.uint64(32))) * _MIX
    return (joined ^ (joined >> np.uint64(29))) * _MIX >> np.uint64(24)


def _smallest(parts: list) -> list:
    """The ``KEEP`` smallest distinct values of some arrays, ascending."""
    every = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if len(every) > 8 * KEEP:
        some = np.unique(np.partition(every, 4 * KEEP)[:4 * KEEP])
        if len(some) >= KEEP:
            return some[:KEEP].tolist()
    return np.unique(every)[:KEEP].tolist()


class Fingerprint:
    """Length, whole hash and smallest span hashes; ``str`` writes and ``parse`` reads it."""

    def __init__(self, length: int, whole: tuple, smallest: list):
        self.length, self.whole, self.smallest = length, whole, smallest

    def __str__(self) -> str:
        return f"{self.length:x}:{self.whole[0]:08x}{self.whole[1]:08x}:" + "".join(f"{h:010x}" for h in self.smallest)

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        length, whole, spans = text.split(":")
        return cls(int(length, 16), (int(whole[:8], 16), int(whole[8:], 16)),
                   [int(spans[i:i + 10], 16) for i in range(0, len(spans), 10)])

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts; else the share of the smallest spans of both that both have."""
        if (self.length, self.whole) == (other.length, other.whole):
            return 1.0
        mine, theirs = set(self.smallest), set(other.smallest)
        least = sorted(mine | theirs)[:KEEP]
        return sum(h in mine and h in theirs for h in least) / len(least) if least else 0.0


class _Document:
    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.hash = PrefixHash(text)
        self.spans = self.hash.spans()
        self.print = Fingerprint(self.hash.n, self.hash.span(0, self.hash.n), _smallest([self.spans]))

    def edited(self, following: _Document) -> tuple:
        """(text, fingerprint) with the last third replaced by the start of the following text."""
        n = self.hash.n
        keep, take = n - n // 3, min(n // 3, following.hash.n)
        text = self.text[:keep] + following.text[:take]
        # sums of a joined text: those of the first, then those of the second shifted by B^keep
        whole = tuple((int(a[keep]) + int(b[take]) * int(p.upto(keep + SPAN)[0][keep])) % PRIME
                      for a, b, p in zip(self.hash.sums, following.hash.sums, _POWERS))
        seam = PrefixHash(self.text[max(0, keep - SPAN + 1):keep] + following.text[:min(take, SPAN - 1)])
        before = min(keep, SPAN - 1)
        # a text shorter than a span: its first spans are those of the seam, which starts where it starts
        crossing = seam.spans()[before:]
        return text, Fingerprint(keep + take, whole, _smallest(
            [self.spans[:keep], crossing, following.spans[SPAN - 1:take]]))


def fingerprint(text: str | None) -> str:
    return str(_Document(None, text or "").print)


_COLUMNS = ("doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, bucket = None, None
    for batch in batches:
        ids, out = [], [[] for _ in range(6)]
        rows = zip(batch.column("bucket").to_pylist(), batch.column("ahead").to_pylist(),
                   batch.column("doc_id").to_pylist(), batch.column("text"))
        for where, ahead, doc_id, text in rows:
            if ahead and (held is None or where != bucket):
                continue  # further rows of the next bucket's first id
            now = _Document(doc_id, text.as_py() or "")
            if held is not None and where == bucket:
                text_, edited = held.edited(now)
                ids.append(held.doc_id)
                for column, value in zip(out, (
                        held.hash.n, hashlib.sha256(text_.encode("utf-8", "surrogatepass")).hexdigest(), str(held.print),
                        str(edited), held.print.likeness(edited), held.print.likeness(now.print))):
                    column.append(value)
            held, bucket = (None, None) if ahead else (now, where)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.column("doc_id").type), *[pa.array(c, k) for c, k in zip(out, kinds)]],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def neighbours(docs: DataFrame, buckets_a_partition: int = 4) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * buckets_a_partition
    # bounds of the buckets: as many numbers as buckets
    bounds = sorted({int(b) for b in rows.select(F.col("doc_id").cast("long").alias("doc_id")).stat.approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)}, reverse=True) if parts > 1 else []

    def bucket(ids: Iterator) -> Iterator:
        ascending = np.array(bounds[::-1], np.int64)
        for some in ids:
            known = some.notna()
            at = np.full(len(some), len(bounds) + 1, np.int32)  # null ids come last
            # descending order: ids above the largest bound are in bucket 0
            at[known.to_numpy()] = len(ascending) - np.searchsorted(
                ascending, some[known].astype("int64").to_numpy(), side="left")
            yield _series(at)

    bucket_of = F.pandas_udf(_typed(bucket), "int")
    heads = (docs.select("doc_id").distinct().withColumn("bucket", bucket_of(F.col("doc_id").cast("long")))
             .groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect())  # a row a bucket
    if not heads:
        return spark.createDataFrame([], _COLUMNS.format(kind=kind))
    # a bucket's first document goes to the bucket before; the very first to the last
    sent = [(h["head"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    target = spark.createDataFrame(sent, f"head {kind}, bucket int")
    own = rows.select("doc_id", "text", bucket_of(F.col("doc_id").cast("long")).alias("bucket"), F.lit(False).alias("ahead"))
    ahead = (rows.join(F.broadcast(target), rows["doc_id"].eqNullSafe(target["head"]))
             .select("doc_id", "text", "bucket", F.lit(True).alias("ahead")))
    return (own.unionAll(ahead).repartition("bucket")
            .sortWithinPartitions("bucket", "ahead", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(_worked, _COLUMNS.format(kind=kind)))


def _series(values: np.ndarray):
    import pandas as pd

    return pd.Series(values)


def _typed(function):
    """A pandas UDF's type is read from its hints."""
    import pandas as pd

    function.__annotations__ = {"ids": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return function

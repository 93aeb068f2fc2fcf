"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled
text. A text resembles the class whose dictionary makes it smaller: the
difference of the two compressed sizes, normalised by their sum, is turned
into a probability by a logistic calibration (together with how far the text
compresses by itself) that is fitted on labelled rows which took no part in
the dictionaries.

Texts are compressed in blocks of ``BLOCK`` bytes, each on its own, over the
whole text. Without blocks a long text would become its own dictionary and
the difference would vanish with the length.

The model is a few hundred kilobytes whatever the corpus: it is fitted on at
most ``MAX_ROWS`` labelled rows per class, each of at most ``MAX_BYTES``
bytes, chosen by the hash of their id. Everything else covers all rows.

Defined results: a null text counts as empty; an empty text scores 0; without
labelled rows of both classes every other text scores 0.5; repeated rows each
come out, with one score; columns named like the result's are replaced by it, all
others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, whole_text

BLOCK = 1024
DICT_BYTES = 64 * 1024
LEVEL = 3
MAX_ROWS = 1500
MAX_BYTES = 32 * 1024
KEEP_AT = 0.3


@dataclass(frozen=True)
class CompressionModel:
    """Both dictionaries and the calibration; None for dictionaries that could not be trained."""

    good: bytes | None
    bad: bytes | None
    weights: tuple


def _compressor(dictionary: bytes | None):
    if dictionary is None:
        return zstd.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
    trained = zstd.ZstdCompressionDict(dictionary)
    trained.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(dict_data=trained, write_checksum=False, write_content_size=False,
                               write_dict_id=False)


class _Measure:
    """Features of a text from its compressed sizes with the good, the bad and no dictionary.

    1; the normalised size difference of the whole text and of its worst block; the share of
    blocks that the bad dictionary makes smaller; the plain compressed size by length of the
    whole text and of its most repetitive block.
    """

    WIDTH = 6

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad, self.plain = _compressor(good), _compressor(bad), _compressor(None)

    def __call__(self, text: str) -> list:
        raw = text.encode("utf-8", "surrogatepass")
        if not raw:
            return [0.0] * self.WIDTH
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        if len(blocks) > 1 and len(blocks[-1]) < BLOCK // 4:  # a scrap tells little on its own
            blocks[-2:] = [blocks[-2] + blocks[-1]]
        good = [len(self.good.compress(b)) for b in blocks]
        bad = [len(self.bad.compress(b)) for b in blocks]
        plain = [len(self.plain.compress(b)) / len(b) for b in blocks]
        diffs = [(b - g) / (b + g) for g, b in zip(good, bad)]
        whole = (sum(bad) - sum(good)) / (sum(bad) + sum(good))
        return [1.0, 10 * whole, 10 * min(diffs), sum(d < 0 for d in diffs) / len(diffs),
                len(self.plain.compress(raw)) / len(raw), min(plain)]


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-1) -> np.ndarray:
    """Weighted logistic regression: Newton's steps, halved until the penalised loss falls."""

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float(weight @ (np.logaddexp(0, z) - y * z) + ridge * beta @ beta / 2)

    beta = np.zeros(x.shape[1])
    now = loss(beta)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(beta + size * step) > now:
            size /= 2
        after = loss(beta + size * step)
        if now - after < 1e-9:
            break
        beta, now = beta + size * step, after
    return beta


def _dictionary(texts: list) -> bytes | None:
    samples = [b for t in texts for raw in [t.encode("utf-8", "surrogatepass")]
               for b in (raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)) if len(b) >= 8]
    total = sum(map(len, samples))
    try:
        return zstd.train_dictionary(max(256, min(DICT_BYTES, total // 8)), samples, level=LEVEL).as_bytes()
    except (zstd.ZstdError, ValueError):
        # Too little text to select from: the text itself serves as a raw dictionary.
        raw = b"".join(samples)[-DICT_BYTES:]
        return raw or None


def fit(rows: list, counts: dict | None = None) -> CompressionModel:
    """Fit on ``(text, label)`` rows. ``counts``: labelled rows by class, for the calibration's prior."""
    by_class = {label: [t for t, y in rows if y == label and t] for label in (0, 1)}
    if min(map(len, by_class.values())) == 0:
        return CompressionModel(None, None, ())
    halves = {y: (texts[0::2], texts[1::2] or texts) for y, texts in by_class.items()}
    good, bad = _dictionary(halves[1][0]), _dictionary(halves[0][0])
    if good is None or bad is None:
        return CompressionModel(None, None, ())
    measure = _Measure(good, bad)
    held = [(t, y) for y in (0, 1) for t in halves[y][1]]
    x = np.array([measure(t) for t, _ in held])
    y = np.array([label for _, label in held], dtype=float)
    counts = counts or {}
    share = {c: counts.get(c, len(by_class[c])) / max(1, len(halves[c][1])) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    return CompressionModel(good, bad, tuple(_calibrate(x, y, weight * len(y) / weight.sum())))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality",
          max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> CompressionModel:
    """Fit on a bounded sample of the labelled rows: ``max_rows`` per class, by hash of doc_id.

    ``labels`` holds only rows to learn from. Ids labelled both ways, null ids and null labels
    teach nothing. Collected: at most ``2 * max_rows`` ids, then their texts of at most
    ``max_bytes`` bytes each.
    """
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
             .where("lo = hi").select("doc_id", F.col("lo").cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in clean.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = [clean.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
              for c in (0, 1)]
    ids = [(r["doc_id"], r["y"]) for c in chosen for r in c.collect()]
    spark = documents.sparkSession
    kind = dict(documents.dtypes)["doc_id"]
    few = spark.createDataFrame(ids, f"doc_id {kind}, y int")  # at most 2 * max_rows rows
    # one text for each id, also where rows repeat it
    rows = (documents.where(F.octet_length("text") <= max_bytes).select("doc_id", "text")
            .join(F.broadcast(few), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
            .orderBy("doc_id").collect())
    return fit([(r["text"], r["y"]) for r in rows], counts)


def score(model: CompressionModel, text: Column, at_once: int = 64) -> Column:
    """Probability of label 1 for a text column (null: empty). A few texts of an Arrow batch are Python objects at a time."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        measure = _Measure(model.good, model.bad) if model.weights else None
        beta = np.array(model.weights)
        for texts in batches:
            out = np.zeros(len(texts))
            for i in range(0, len(texts), at_once):
                for k, one in enumerate(texts.slice(i, at_once).to_pylist(), i):
                    if one:
                        out[k] = 0.5 if measure is None else 1 / (1 + np.exp(-np.clip(np.array(measure(one)) @ beta, -30, 30)))
            yield pa.array(out)

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents with the columns held_out, score and predicted added (replacing same names)."""
    prepare(documents.sparkSession)
    model = train(documents, labels.where(~held_out(F.col("doc_id"))))
    return (documents.withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("score", score(model, whole_text()))
            .withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int")))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, all columns as they are, whatever their names."""
    prepare(documents.sparkSession)
    model = train(documents, labels.where(~held_out(F.col("doc_id"))))
    return documents.where(score(model, whole_text()) >= KEEP_AT)

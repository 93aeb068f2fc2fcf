"""Near-duplicate vectors by product quantisation over inverted lists.

1. *Model*, on a bounded sample: centroids of the inverted lists (k-means) and,
   for each of ``SUBSPACES`` parts of the residuals to them, ``WORDS`` codewords.
2. *Index*, every vector: its list, its residual's codes, and the length of
   what the codes miss (its error).
3. *Probes*: a vector probes every list whose border with its own list lies
   within the link distance: a neighbour on the other side of the border is at
   least that far, so no link is missed, whatever the data's shape. Of two
   lists the lower one's vectors probe the higher one, so that each pair meets
   once.
4. *Search*: squared distances to the codes by table look-up (one table a
   vector). Codes err by at most the stored error, so a vector is dropped only
   if its looked-up distance less its error exceeds the link distance; what
   remains is ranked by the exact cosine in double precision.
5. *Links* are counted where they are found and only a spanning forest of them
   leaves the task; components follow.

Equal vectors are one class with a count, so copies cost nothing. The members
of a list are cut into blocks of ``BLOCK`` and those that probe it into chunks
of ``CHUNK``; each pair of blocks is a unit of work, so a hot list is spread.

Vectors of each length are searched by themselves, with a model of their own;
the lengths in use are few and the driver goes through them.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing, and neither do rows without an id
(component null). Vectors of different lengths do not link.
Rows that repeat an id are vectors of their own; they share its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, whole_groups, written
from strata.llm.components import components, roots

COSINE = 0.95
SUBSPACES = 8
WORDS = 64
LIST_SIZE = 1024
MAX_LISTS = 2048
SAMPLE_A_LIST = 64
SLICE = 1024
MAX_SAMPLE = 32768
BLOCK = 1024
CHUNK = 4096
_SEED = 7


@dataclass(frozen=True)
class Model:
    """Lists' centroids, codewords by subspace, the subspaces' bounds, the cosine to link at."""

    centroids: np.ndarray
    words: list
    bounds: list
    cosine: float

    @property
    def distance(self) -> float:
        """Distance of unit vectors at the cosine."""
        return math.sqrt(max(0.0, 2 - 2 * self.cosine))

    def margin(self) -> float:
        """How near a border must be for its other side to hold a neighbour."""
        return self.distance + 1e-6

    def lists(self, x: np.ndarray) -> tuple:
        """(own list, whether each list is probed) of unit vectors."""
        near = 2 * x @ self.centroids.T - (self.centroids ** 2).sum(axis=1)
        own = near.argmax(axis=1)
        gaps = _gaps(self.centroids)
        border = (near[np.arange(len(x)), own][:, None] - near) / (2 * gaps[own])
        probed = (border <= self.margin()) & (np.arange(len(self.centroids))[None, :] > own[:, None])
        return own, probed

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple:
        """(codes, errors) of unit vectors in their lists."""
        residual = x - self.centroids[own]
        codes = np.zeros((len(x), len(self.words)), np.uint8)
        missed = np.zeros(len(x))
        for m, (words, (lo, hi)) in enumerate(zip(self.words, self.bounds)):
            part = residual[:, lo:hi]
            codes[:, m] = (2 * part @ words.T - (words ** 2).sum(axis=1)).argmax(axis=1)
            missed += ((part - words[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(missed)

    def lookup(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distances of unit vectors to coded ones of a list, summed from a table for each vector."""
        residual = x - self.centroids[cell]
        total = np.zeros((len(x), len(codes)))
        for m, (words, (lo, hi)) in enumerate(zip(self.words, self.bounds)):
            part = residual[:, lo:hi]
            table = (part ** 2).sum(axis=1)[:, None] - 2 * part @ words.T + (words ** 2).sum(axis=1)[None, :]
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _gaps(centroids: np.ndarray) -> np.ndarray:
    """Distances between centroids."""
    square = (centroids ** 2).sum(axis=1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * centroids @ centroids.T, 1e-12))


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centers = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = np.concatenate([(2 * x[i:i + 4096] @ centers.T - (centers ** 2).sum(axis=1)).argmax(axis=1)
                              for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=k)
        centers[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0][:, None]
    return centers


def fit(sample: np.ndarray, lists: int, cosine: float = COSINE) -> Model:
    """Model from unit vectors."""
    rng = np.random.default_rng(_SEED)
    centroids = _kmeans(sample, lists, 8, rng)
    own = (2 * sample @ centroids.T - (centroids ** 2).sum(axis=1)).argmax(axis=1)
    residual = sample - centroids[own]
    d = sample.shape[1]
    cuts = np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int).tolist()
    bounds = list(zip(cuts[:-1], cuts[1:]))
    words = [_kmeans(residual[:8192, lo:hi], WORDS, 8, rng) for lo, hi in bounds]
    return Model(centroids, words, bounds, cosine)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision over their length (scaled first, so that no square overflows)."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _can_link() -> Column:
    """Whether a row's vector can link at all."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
                      & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0), F.lit(False))


def _matrix(column, kind) -> np.ndarray:
    flat = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def index(classes: DataFrame, model: Model) -> DataFrame:
    """(key, many, embedding, cell, codes, error, probes) of every class."""
    id_type, v_type = dict(classes.dtypes)["key"], dict(classes.dtypes)["embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            x = _unit(_matrix(batch.column("embedding"), np.float64))
            own, probed = model.lists(x)
            codes, errors = model.encode(x, own)
            rows, lists = np.nonzero(probed)
            offsets = np.concatenate([[0], np.bincount(rows, minlength=len(x)).cumsum()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("many"), batch.column("embedding"), pa.array(own.astype(np.int32)),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(lists.astype(np.int32)))],
                names=["key", "many", "embedding", "cell", "codes", "error", "probes"])

    return classes.select("key", "many", "embedding").mapInArrow(
        run, f"key {id_type}, many long, embedding {v_type}, cell int, codes binary, error double, probes array<int>")


def _searched(model: Model):
    def near(x, y, cell, codes, errors, triangle):
        """Index pairs (into x, into y) at the cosine or above; triangle: x and y are the same rows."""
        for i in range(0, len(x), 256):
            some = x[i:i + 256]
            maybe = model.lookup(some, cell, codes) - errors[None, :] <= model.distance + 1e-6
            if triangle:
                maybe &= np.arange(i, i + len(some))[:, None] < np.arange(len(y))[None, :]
            a, b = np.nonzero(maybe)
            for k in range(0, len(a), 65536):
                p, q = a[k:k + 65536], b[k:k + 65536]
                hit = np.einsum("ij,ij->i", some[p], y[q]) >= model.cosine
                yield i + p[hit], q[hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "unit"):
            units, side = rows.column("unit").to_numpy(), rows.column("side").to_numpy()
            ids, many = rows.column("key").to_numpy(), rows.column("many").to_numpy()
            cells, errors = rows.column("cell").to_numpy(), rows.column("error").to_numpy()
            x = _unit(_matrix(rows.column("embedding"), np.float64))
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
            edges = np.flatnonzero(np.diff(units)) + 1
            out = []
            for lo, hi in zip([0, *edges], [*edges, len(units)]):
                # side 0: members to search; side 1: a second block, searched for in the first
                split = lo + int((side[lo:hi] == 0).sum())
                if split == lo:
                    continue
                alone = split == hi
                if alone and not rows.column("own")[lo].as_py():
                    continue
                start = lo if alone else split
                found = list(near(x[start:hi], x[lo:split], int(cells[lo]), codes[lo:split], errors[lo:split], alone))
                a = np.concatenate([p for p, _ in found]) if found else np.empty(0, np.int64)
                b = np.concatenate([q for _, q in found]) if found else np.empty(0, np.int64)
                if len(a) == 0:
                    continue
                a, b = a + start - lo, b
                n = hi - lo
                links = np.bincount(a, many[lo + b], n) + np.bincount(b, many[lo + a], n)
                root = roots(n, a, b)
                some = np.flatnonzero(links)
                out.append((ids[lo + some], ids[lo + root[some]], links[some].astype(np.int64)))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])

    return run


def links(indexed: DataFrame, model: Model) -> DataFrame:
    """(a, b, links): of class a, ``links`` vectors of other classes found in one unit; b spans the links found there."""
    members = indexed.groupBy("cell").agg(F.count("*").alias("n")).select(
        F.col("cell").alias("at"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    probing = indexed.select(F.explode("probes").alias("at")).groupBy("at").agg(
        F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sizes = members.join(probing, "at", "left").fillna(0, ["chunks"])  # a row a list
    body = ["key", "many", "embedding", "codes", "error"]
    home = indexed.withColumnRenamed("cell", "at").join(F.broadcast(sizes), "at").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    place = F.posexplode(F.sequence(F.lit(0), F.col("blocks") + F.col("chunks") - 1))
    dealt = home.select(*body, "at", "block", "blocks", place.alias("_", "other"))
    own = F.col("other") < F.col("blocks")
    from_home = dealt.select(
        *body, F.col("at").alias("cell"),
        F.when(own, F.xxhash64("at", F.lit(0), F.least("block", "other"), F.greatest("block", "other")))
        .otherwise(F.xxhash64("at", F.lit(1), "block", F.col("other") - F.col("blocks"))).alias("unit"),
        F.when(own & (F.col("block") > F.col("other")), 1).otherwise(0).alias("side"), own.alias("own"))
    visiting = (indexed.select(*body, F.explode("probes").alias("at")).join(F.broadcast(sizes), "at")
                .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
                .select(*body, "at", "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
                .select(*body, F.col("at").alias("cell"), F.xxhash64("at", F.lit(1), "block", "chunk").alias("unit"),
                        F.lit(1).alias("side"), F.lit(False).alias("own")))
    return (from_home.unionAll(visiting).repartition("unit").sortWithinPartitions("unit", "side", "key")
            .mapInArrow(_searched(model), "a long, b long, links long"))


def _found(classes: DataFrame, n: int, cosine: float, max_lists: int, max_sample: int) -> DataFrame:
    """``links`` of ``n`` classes of one length."""
    lists = max(1, min(max_lists, n // LIST_SIZE))
    sample = classes.orderBy(F.xxhash64("rep", "embedding"), "key").limit(min(max_sample, max(SAMPLE_A_LIST * lists, 4 * WORDS)))
    model = fit(_unit(_matrix(sample.select("embedding").toArrow().column("embedding"), np.float64)), lists, cosine)
    return written(links(written(index(classes, model), "index"), model), "links")


def link(vectors: DataFrame, cosine: float = COSINE, max_lists: int = MAX_LISTS, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    A length's model is fitted on at most ``max_sample`` classes, by hash; beyond ``max_lists`` lists of
    ``LIST_SIZE`` vectors the lists grow and are worked through in blocks.
    """
    prepare(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    can = _can_link()
    fine = vectors.where(can)
    classes = written(fine.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
                      .withColumn("key", F.monotonically_increasing_id()), "classes")
    rest = vectors.where(~can).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sizes = classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # a row a length
    if not sizes:
        return rest
    found = vectors.sparkSession.createDataFrame([], "a long, b long, links long")
    for d, n in sizes:
        if n > 1:
            found = found.unionAll(_found(classes.where(F.size("embedding") == d), n, cosine, max_lists, max_sample))
    counts = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("others"))
    # rows to their class again: copies are linked with each other, and all of them with the class's links
    linked = fine.join(classes, "embedding").join(counts, "key", "left").select(
        "vec_id", "key", "rep", (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("n"))
    # an id on rows of different vectors joins their classes
    several = linked.groupBy("vec_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b")
    ends = linked.join(several, "vec_id").select(F.col("a"), F.col("key").alias("b"))
    parts = components(found.select("a", "b").unionAll(ends), "a", "b")
    # a component's name is its smallest vector
    names = (parts.join(classes.select(F.col("key").alias("node"), "rep"), "node")
             .groupBy("component").agg(F.min("rep").alias("least")))
    named = parts.join(names, "component").select(F.col("node").alias("key"), "least")
    placed = linked.join(named, "key", "left").select("vec_id", "n", F.coalesce("least", "rep").alias("component"))
    return (placed.select("vec_id", F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"),
                          (F.col("component") == F.col("vec_id")).alias("kept")).unionAll(rest))

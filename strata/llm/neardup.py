"""Near-duplicate texts by the chosen-path set similarity join over minhash tokens.

A text's set is its distinct 5-word shingles (ASCII-lower-cased, words between
white space), as 64-bit hashes. Two texts are linked when the Jaccard
similarity of their full sets is at least ``THRESHOLD`` percent.

1. *Sketch* (one pass in tasks): size, digest and ``COORDS`` minwise tokens of
   each set. Texts with equal digests are copies; one represents them.
2. *Trees*: ``TREES`` independent trees branch the representatives by minwise
   tokens. A node of at most ``SMALL`` members is compared exhaustively on the
   sketches; a larger one branches on ``BRANCH`` further coordinates that its
   path selects. A child that keeps at least ``DENSE`` of a large node's
   members will not split much further, so its members count as one candidate
   group, as do those of a large node at ``DEPTH``. Two texts linked at 85 % miss each other in a tree's first branch
   with probability 0.15, so in all eight with 3 in 10 million; the estimate
   from 128 tokens falls below ``LIKELY`` with about 1 in 50,000.
3. *Candidate groups* are the connected components of the pairs found likely.
4. *Exact check* inside each group on the full sets: a group's members are cut
   into blocks of ``BLOCK`` and every pair of blocks is one unit of work that
   returns a spanning forest of the links found, never all pairs. So a group
   of thousands is spread over many tasks, whole.
5. The components of the confirmed links are the result.

Defined results: texts without words (or null) have empty sets and link with
nothing; texts of one to four words have one shingle, the whole sequence.
Rows that repeat a doc_id share its component; rows with a null doc_id cannot
be named by others: they link with nothing, their component is null and they
are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, whole_groups, written
from strata.llm.components import components, roots

SHINGLE = 5
THRESHOLD = 85          # percent
COORDS = 128
TREES = 8
SMALL = 64
BRANCH = 2
DEPTH = 6
DENSE = 0.6
LIKELY = 0.72
BLOCK = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEED = 20240229


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's 5-word shingles."""
    # bytes.lower and bytes.split touch exactly A-Z and the ASCII white space
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), _SEED)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    mixed = h[:n].copy()
    for k in range(1, SHINGLE):
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
        mixed += h[k:n + k]
    return np.unique(mixed)


def _multipliers() -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 2 ** 31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


_FACTORS = _multipliers()


def minwise(values: np.ndarray) -> np.ndarray:
    """One minwise token for each coordinate, as signed 32-bit."""
    low = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    least = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        part = low[i:i + 2048, None] * _FACTORS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return least.view(np.int32)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, tokens = [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py())
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            tokens.append(minwise(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(tokens, pa.list_(pa.int32()))],
            names=["doc_id", "n_shingles", "digest", "tokens"])


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, tokens) of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _sketched, f"doc_id {kind}, n_shingles long, digest binary, tokens array<int>")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of small nodes, sorted by path: (a, b) links each member to its group's first one."""
    for members in whole_groups(batches, "path"):
        path = members.column("path").to_numpy()
        ids = members.column("rep")
        n = len(path)
        tokens = members.column("tokens").combine_chunks().flatten().to_numpy().reshape(n, COORDS)
        pairs = []
        for ahead in range(1, SMALL):
            first = np.flatnonzero(path[:n - ahead] == path[ahead:]) if ahead < n else []
            if len(first) == 0:
                break
            for i in range(0, len(first), 4096):
                some = first[i:i + 4096]
                alike = (tokens[some] == tokens[some + ahead]).mean(axis=1) >= LIKELY
                pairs.append(np.stack([some[alike], some[alike] + ahead]))
        a, b = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
        root = roots(n, a, b)
        linked = np.flatnonzero(root != np.arange(n))
        yield pa.RecordBatch.from_arrays(
            [pa.chunked_array(ids).take(pa.array(root[linked])).combine_chunks(),
             pa.chunked_array(ids).take(pa.array(linked)).combine_chunks()], names=["a", "b"])


def likely_pairs(reps: DataFrame) -> DataFrame:
    """(a, b) spanning the pairs of ``reps`` (rep, tokens) that share a node and look alike there."""
    coordinates = np.random.default_rng(_SEED + 1).permutation(COORDS)[:TREES].tolist()
    kind = dict(reps.dtypes)["rep"]
    found = []
    rows = reps.select("rep", F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.element_at("tokens", c + 1)) for t, c in enumerate(coordinates)])).alias("path"),
        F.lit(0).cast("long").alias("above"))
    for depth in range(1, DEPTH + 1):
        sized = rows.groupBy("path").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1")
        shared = rows.join(sized, "path")
        if depth == 1:
            shared = shared.join(reps, "rep")  # only members of nodes with company carry their tokens
        shared = written(shared, f"nodes-{depth}")
        found.append(shared.where(F.col("size") <= SMALL).select("path", "rep", "tokens")
                     .repartition("path").sortWithinPartitions("path", "rep")
                     .mapInArrow(_compared, f"a {kind}, b {kind}"))
        large = shared.where(F.col("size") > SMALL)
        dense = F.lit(True) if depth == DEPTH else F.col("size") >= DENSE * F.col("above")
        found.append(large.where((F.col("above") > 0) & dense).select(
            F.col("least").alias("a"), F.col("rep").alias("b")).where("a <> b"))
        rest = large.where(~((F.col("above") > 0) & dense))
        if depth == DEPTH or rest.isEmpty():
            break
        rows = rest.select("rep", "tokens", F.col("size").alias("above"), F.explode(
            F.array_distinct(F.array(*[_child(depth, j) for j in range(BRANCH)]))).alias("path"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _child(depth: int, branch: int) -> Column:
    """The path of a child: the parent's path selects the coordinate."""
    at = F.pmod(F.xxhash64("path", F.lit(depth), F.lit(branch)), F.lit(COORDS)).cast("int")
    return F.xxhash64("path", at, F.element_at("tokens", at + 1))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("grp"), pa.array(sets, pa.binary())],
                                         names=["rep", "grp", "members"])


def _forest(sets: list, split: int) -> tuple:
    """Links that span the linked members of one unit.

    ``split``: members before it are the first block, the rest the second, and only links
    between the blocks are looked for; 0: one block, all its pairs.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    flags = np.zeros(len(values), np.int64)
    root = np.arange(n)
    a, b = [], []
    for i in range(split or n):
        others = np.arange(split, n) if split else np.arange(i + 1, n)
        if not (root[others] != root[i]).any():
            continue
        own = local[starts[i]:starts[i] + sizes[i]]
        flags[own] = 1
        begin = starts[others[0]]
        common = np.add.reduceat(flags[local[begin:]], starts[others] - begin)
        flags[own] = 0
        hit = others[(100 * common >= THRESHOLD * (sizes[i] + sizes[others] - common)) & (root[others] != root[i])]
        for j in hit:
            if root[j] != root[i]:
                a.append(i)
                b.append(j)
                low, high = sorted((root[i], root[j]))
                root[root == high] = low
    return a, b


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit_rows in whole_groups(batches, "unit"):
        units = unit_rows.column("unit").to_numpy()
        second = unit_rows.column("second").to_numpy()
        ids = unit_rows.column("rep")
        members = unit_rows.column("members")
        edges = np.flatnonzero(np.diff(units)) + 1
        left, right = [], []
        for lo, hi in zip([0, *edges], [*edges, len(units)]):
            sets = [np.frombuffer(members[int(k)].as_buffer(), np.uint64) for k in range(lo, hi)]
            split = int((~second[lo:hi]).sum()) if second[lo:hi].any() else 0
            if split == hi - lo or (second[lo:hi].all()):
                split = 0
            a, b = _forest(sets, split)
            left += [lo + i for i in a]
            right += [lo + j for j in b]
        take = lambda rows: pa.chunked_array(ids).take(pa.array(rows, pa.int64())).combine_chunks()
        yield pa.RecordBatch.from_arrays([take(left), take(right)], names=["a", "b"])


def confirmed_links(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b) spanning the exact links inside candidate groups (rep, grp)."""
    kind = dict(groups.dtypes)["rep"]
    sizes = groups.groupBy("grp").agg(F.count("*").alias("size"))
    placed = groups.join(sizes, "grp").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    texts = (docs.select(F.col("doc_id").alias("rep"), "text")
             .join(placed, "rep").select("rep", "grp", "blocks", "text"))
    sets = texts.select("rep", "grp", "text").mapInArrow(_hashed, f"rep {kind}, grp {kind}, members binary")
    sets = written(sets.dropDuplicates(["rep", "members"]), "sets")
    # a member's block by hash; it takes part in the units of its block with every block
    blocked = sets.join(placed.select("rep", "blocks"), "rep").withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = blocked.select("rep", "grp", "members", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = dealt.select(
        "rep", "members", (F.col("own") > F.col("other")).alias("second"),
        F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("unit"))
    return (units.repartition("unit").sortWithinPartitions("unit", "second", "rep")
            .mapInArrow(_confirmed, f"a {kind}, b {kind}"))


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    sketches = written(sketch(docs), "sketches")
    named = sketches.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    copies = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"))
    reps = written(copies, "reps")
    pairs = written(likely_pairs(reps.select("rep", "tokens")), "likely")
    groups = components(pairs, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    links = written(confirmed_links(docs, written(groups, "groups")), "links")
    of_copies = named.select("doc_id", "digest").join(reps.select("digest", "rep"), "digest").select("doc_id", "rep")
    # an id on rows of different texts joins their components
    several = of_copies.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    own = of_copies.join(several.select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    parts = components(links.unionAll(own), "a", "b")
    placed = (of_copies.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
              .select("doc_id", F.coalesce("component", "rep").alias("component"))
              .groupBy("doc_id").agg(F.min("component").alias("component")))
    return (sketches.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each group stays: the smallest id, and of rows repeating an id with one text one.

    Rows with a null doc_id stay. All columns are left as they are.
    """
    kept = link(docs).where("kept").select("doc_id").distinct()
    nameless = docs.where(F.col("doc_id").isNull())
    return docs.join(kept.where(F.col("doc_id").isNotNull()), "doc_id", "left_semi").select(
        *docs.columns).dropDuplicates(["doc_id", "text"]).unionAll(nameless)
